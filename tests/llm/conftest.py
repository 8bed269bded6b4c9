import random

import pytest

from snapstats.llm.common import ready


@pytest.fixture(scope="session")
def sc(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def prose():
    """Sentences of invented words, the same every time."""
    def make(n, seed):
        rng = random.Random(seed)
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
        out = []
        while len(out) < n:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randint(4, 14))).capitalize() + ".")
        return out

    return make


@pytest.fixture(scope="session")
def awkward(sc, prose):
    """Documents with nulls, empty, very long and repeated texts, ties, and columns named like the operators' own."""
    s = prose(400, 1)
    long = "\n".join(prose(3000, 2))
    passage = " ".join(s[:12])
    rows = [
        (1, None, None), (2, "", "en"), (3, "  \n\t ", "en"), (4, "7 !? 9", "en"), (5, " ".join(s[20:60]), "en"), (6, " ".join(s[20:60]), "en"),
        (7, long, "en"), (8, passage + " " + " ".join(s[60:80]), "en"), (9, " ".join(s[80:95]) + " " + passage, "en"),
        (10, " ".join(s[20:59]) + " " + s[61], "en"), (11, "x" * 1500, "en"), (12, "é€𝄞\n" * 300, None), (None, " ".join(s[20:60]), "en"),
        (13, "one two three", "en"), (13, "one two three", "en"), (14, "ONE two\x0bthree", "en"), (15, s[100] + "\n" + s[101], "fr"),
        (16, "Licensed under CC BY-NC 4.0.", "en"), (17, "a\x1cb\x85c " * 40, "en"), (18, passage, "en"), (None, None, None),
    ]
    names = ("key", "row", "rest", "hits", "items", "n", "start", "part", "set", "bands", "component", "text_hash", "node", "kept", "score", "edits_")
    extra = ", ".join(f"{c} string" for c in names)
    return sc.createDataFrame([(d, t, lang, "src", len(t or "")) + ("z",) * len(names) for d, t, lang in rows],
                              f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


@pytest.fixture(scope="session")
def none(awkward):
    return awkward.where("1 = 0")
