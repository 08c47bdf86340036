import random

import pytest

#: Columns that the operators use inside: an input may hold them too.
CLASHING = ("set", "n", "score", "size", "doc", "start", "hash", "sig", "keep", "copies", "bucket", "t", "h", "row")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))


def make_texts(seed=1, n=60):
    """Random texts with exact and near copies, shared passages, and odd rows."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(400)]

    def fresh(k):
        return " ".join(rnd.choice(vocabulary) for _ in range(k))

    passage = fresh(60)
    texts = [fresh(rnd.randint(1, 180)) for _ in range(n)]
    for _ in range(n // 3):
        base = rnd.choice(texts).split()
        for _ in range(rnd.randint(0, 1 + len(base) // 25)):
            base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
        texts.append(" ".join(base))
    for _ in range(n // 6):
        texts.append(fresh(rnd.randint(0, 40)) + "\n" + passage + " " + fresh(rnd.randint(0, 40)))
    hub = fresh(120).split()
    for _ in range(n // 4):
        copy = list(hub)
        for _ in range(2):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [None, "", "  \n\t ", "one", "one", "Two words", "two  words", "a b c d", "a b c d e", "A B C D E",
              "same " * 300, "same " * 301, fresh(9000), "İ ſ K ß 漢字 \x00 \x85 \xa0 x", "12 34 !!"]
    return texts


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHING)


def frame(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
        full.append((doc_id, text, lang, source, None if text is None else len(text), *("x",) * len(CLASHING)))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, [(i * 3 % 997, t, None if i % 11 == 0 else "en", None if i % 13 == 0 else f"s{i % 4}")
                         for i, t in enumerate(texts)]).repartition(5).cache()


@pytest.fixture(scope="session")
def rows(docs):
    """doc_id -> text"""
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
