"""Words of letters go to the merges as they are, with the ids of the library."""

import struct

from evidra.llm import planes


def test_letters_are_not_cut_again():
    by = planes.Encoder(planes.vocabulary())
    words = ["house", "über", "Straße", "éèà", "x", "ŋoɏ"]
    want = {w: by.library.encode(" " + w, add_special_tokens=False).ids for w in words}
    by.stretches = None
    assert {w: list(struct.unpack(f"<{len(by.words[w]) // 4}I", by.words[w])) for w in words} == want
