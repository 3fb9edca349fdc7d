import random

from evidra.llm import chat

from .helpers import same

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_oracle(spark):
    same(chat.op2_chat(spark, SF), chat.ORACLE_SQL["op2_chat"], SF)


def brute(rows):
    out, before, runs = "", None, []
    for role, text in rows:
        r, t = role.replace("<|", "<||").replace("\n", "<|n|>"), text.replace("<|", "<||")
        head = "<|im_sep|>" if before == role else ("<|im_end|>\n" if before is not None else "") + f"<|im_start|>{r}\n"
        out += head + t
        runs += [(len(head), False), (len(t), role == "assistant")]
        before = role
    return out + "<|im_end|>\n", [*runs, (11, False)]


def test_round_trip_masks_and_segments(spark):
    rng = random.Random(6)
    bits = ["<|", "|", "<", "<|im_end|>", "<|im_sep|>", "<|im_start|>", "<||", "a", "\n", "é🙂", ""]
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "sys<|\ntem"]), "".join(rng.choice(bits) for _ in range(rng.randrange(7)))) for _ in range(rng.choice([1, 3, 8, 700]))]
        want[conv] = turns
        rows += [(conv, i, r, t, "x") for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    made = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    seen = 0
    for r in made.select("*", chat.read_back(made.formatted).alias("back")).collect():
        text, runs = brute(want[r.conv_id])
        assert r.formatted == text
        assert [(x.role, x.text) for x in r.back] == want[r.conv_id]
        assert [tuple(x) for x in r.loss_runs] == runs
        at, masked = 0, []
        for n, loss in r.loss_runs:
            masked += [r.formatted[at : at + n].replace("<||", "<|")] * loss
            at += n
        assert at == len(r.formatted)
        assert "".join(masked) == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        seen += 1
    assert seen == 60


def test_nulls_empties_repeats(spark):
    rows = [(None, 1, "user", "a", ""), (1, None, None, None, ""), (1, 2, "user", "b", ""), (1, 2, "user", "b", ""), (2, 1, "assistant", "x" * 300_000, "")]
    made = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    back = {r.conv_id: [(x.role, x.text) for x in r.back] for r in made.select("conv_id", chat.read_back(made.formatted).alias("back")).collect()}
    assert back == {None: [("user", "a")], 1: [("", ""), ("user", "b"), ("user", "b")], 2: [("assistant", "x" * 300_000)]}
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_many_turns_of_one_number(spark):
    rows = [(1, None, "user" if i % 3 else "assistant", f"text {i:05d}") for i in range(4000)] + [(1, 5, "user", "last")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.formatted(df).select(chat.read_back(chat.F.col("formatted")).alias("t")).first().t
    assert [(x.role, x.text) for x in out] == [(r, t) for _, _, r, t in sorted(rows[:-1], key=lambda r: (r[2], r[3]))] + [("user", "last")]
