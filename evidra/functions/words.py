"""Word lists and patterns that decide results and must stay as they are."""

QUESTION_WORDS = ["who", "what", "when", "where", "why", "how", "is", "are", "was", "were", "do", "does", "did", "can", "could", "will", "would", "should"]
NOT_QUESTIONS = ["what happened", "what occurred"]

SMALL_WORDS = ["and", "or", "but", "the", "a", "an"]
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
SHORT_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

PROMOTIONS = [
    (r"(visit|go\s+to|check\s+out)\s+\w+\.(com|io|org)", "Contains website promotion"),
    (r"(special|exclusive)\s+(deal|offer|discount)", "Contains marketing offer"),
    (r"use\s+(code|promo)", "Contains promo code"),
    (r"sign\s+up\s+(now|today)", "Contains signup CTA"),
    (r"subscribe\s+(now|today)", "Contains subscribe CTA"),
    (r"hit\s+that\s+subscribe\s+button", "Contains subscribe button CTA"),
    (r"enable\s+notifications", "Contains notification CTA"),
    (r"brought\s+to\s+you\s+by", "Contains sponsorship mention"),
    (r"our\s+sponsor", "Contains sponsor mention"),
]
#: Strings of which whatever a pattern of ``PROMOTIONS`` matches holds one.
PROMOTION_MARKS = [[".com", ".io", ".org"], ["deal", "offer", "discount"], ["code", "promo"], ["sign"], ["subscribe"], ["subscribe"], ["notifications"], ["brought"], ["sponsor"]]

PRONOUNS = ["he", "she", "they", "it", "him", "her", "them", "his", "hers", "their", "its", "he's", "she's", "they're", "it's"]
VAGUE = ["recently", "soon", "thing", "stuff", "someone", "something", "somehow", "very", "really", "quite"]
OPINION = ["think", "believe", "feel", "seems", "appears", "looks like", "might", "could", "probably", "maybe", "in my opinion", "i believe"]
ADVERT = ["get it today", "order now", "limited time", "sign up", "subscribe", "discount code", "offers", "provides topical", "provides oral", "high-quality basics", "for a fraction", "delivers directly", "get your", "today for only", "only $"]
NO_CONTEXT = ["disapproval is", "approval is", "approval has", "the mantra", "there was a mantra", "the new policy", "the new bill", "the policy will", "the bill will"]

STRICT_OPINION = ["think", "believe", "feel", "seems", "appears", "looks like", "might", "could", "probably", "maybe"]
STRICT_ADVERT = ["get it today", "order now", "limited time", "sign up", "subscribe", "discount code"]
STRICT_CONTEXT = ["the ban", "the bill", "this policy", "the new", "the plan", "the proposal"]

OBVIOUS_ADVERT = ["get it today", "order now", "limited time offer", "subscribe now", "discount code", "act now"]
START_PRONOUNS = ["He", "She", "They", "It", "His", "Her", "Their"]
JUDGED_PRONOUNS = ["he", "she", "they", "him", "her", "his", "their"]
