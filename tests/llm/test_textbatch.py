import random
import re

import numpy as np
import pyarrow as pa
import pytest
from passbook.llm import textbatch


def texts():
    rnd = random.Random(3)
    letters = "abcé ßABC \t\n\x0b-1日 "
    some = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(300)]
    return ["", None, " ", "word", "word", *some, "same words here and same words here and", "x" * 3000, "", "end"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("block", [64, 1 << 20])
def test_words_equal_regex(monkeypatch, kind, block):
    monkeypatch.setattr(textbatch, "BLOCK", block)
    column = pa.array(["skipped", *texts()], kind).slice(1)
    patterns = {"blank": (textbatch.NOT_BLANK, rb"[^\x20\x09-\x0D]+"), "alnum": (textbatch.ALPHANUMERIC, rb"[0-9a-z\x80-\xff]+")}
    for table, pattern in patterns.values():
        found, hashes = [], {}
        for words in textbatch.blocks(column, table):
            per_text = [[] for _ in range(words.n)]
            for k, h in enumerate(words.hashes().tolist()):
                per_text[words.doc[k]].append(words.word(k))
                assert hashes.setdefault(words.word(k), h) == h
            found += per_text
        low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts()]
        assert found == [[w.decode() for w in re.findall(pattern, t.encode())] for t in low]
        assert len(set(hashes.values())) == len(hashes)


def test_grams_stay_in_their_text():
    column = pa.array(["a b c d", "b c", "a b c", None, "a b c d e"])
    (words,) = textbatch.blocks(column)
    found, at = textbatch.grams(words.hashes(), words.doc, 3)
    names = [" ".join(words.word(k + j) for j in range(3)) for k in at.tolist()]
    assert names == ["a b c", "b c d", "a b c", "a b c", "b c d", "c d e"]
    assert len(set(found.tolist())) == 3
    assert found[0] == found[2] == found[3] and found[1] == found[4]
    assert textbatch.grams(np.empty(0, np.uint64), np.empty(0, np.int64), 3)[0].size == 0
