"""Spelling variants against plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from docweave.llm.spelling_variants import near_pairs, spelling_variants, vocabulary, words_of

SCHEMA = "doc_id long, text string, word string, run string, id string, h string, `a b` string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, *["x"] * 5) for i, t in texts], SCHEMA)


def plain_words(texts, least=7, damage=31):
    counts = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def found(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def word(low, high, letters="abcé"):
    return "".join(random.choice(letters) for _ in range(random.randint(low, high)))


@pytest.mark.parametrize(("letters", "low", "high"), [("ab", 7, 9), ("abcdé", 7, 10), ("aÀÿ×z", 6, 8), ("abcdefghijklmnopqrstuvwxyzßñ", 7, 7)])
def test_near_pairs_against_all_pairs(spark, letters, low, high):
    random.seed(len(letters))
    words = {word(low, high, letters) for _ in range(250)}
    # Neighbours of words, so that each kind of edit is there at each place.
    for w in list(words)[:60]:
        i = random.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + random.choice(letters) + w[i + 1 :], w[:i] + random.choice(letters) + w[i:]}
    rows = near_pairs(spark.createDataFrame([(w, n) for n, w in enumerate(sorted(words))], "word string, n long")).select("word", "near").collect()
    want = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(rows) == len(want) and {(r.word, r.near) for r in rows} == want


def test_forms_and_roots(spark):
    # a stands 1000 times and is the form of b, b of c, c of d: the root of all is a; e and f tie for g.
    counts = {"wordaaaaa": 11_000, "wordaaaab": 1000, "wordaaabb": 100, "wordaabbb": 9, "zzzzzzze": 50, "zzzzzzzf": 50, "zzzzzzzg": 5, "lonelyword": 3, "yyyyyyya": 19, "yyyyyyyb": 2}
    assert found(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain_forms(counts)


def test_whole_texts_against_plain(spark):
    random.seed(6)
    known = [word(7, 12, "etaonriéü") for _ in range(40)]
    texts = []
    for i in range(120):
        chosen = random.choices(known, weights=[1 / (k + 1) ** 2 for k in range(40)], k=60)
        texts.append((i, " ".join(w.upper() if random.random() < 0.1 else w for w in chosen) + random.choice([".", "1", "\n", "ÀÈ", ""])))
    texts += [(None, " ".join(known * 3)), (500, None), (501, ""), (502, "short words 1234567 only"), (503, known[0] * 2000 + " " + known[0] * 2000), texts[3], texts[3]]
    counts = {w: n for w, n in plain_words(texts).items() if n >= 2}
    out = found(spelling_variants(vocabulary(words_of(docs(spark, texts)))))
    assert out == plain_forms(counts)
    assert any(form for form, *_ in out.values())


def test_undamaged(spark):
    texts = [(1, "Alphabet alphabet ALPHABET ÀLPHABET x")]
    assert Counter(r.word for r in words_of(docs(spark, texts), damage=0).collect()) == {"alphabet": 3, "Àlphabet": 1}


def test_empty(spark):
    assert spelling_variants(vocabulary(words_of(docs(spark, [])))).collect() == []
    assert spelling_variants(spark.createDataFrame([(None, 3)], "word string, n long")).collect() == []
