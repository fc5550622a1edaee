import random
import re
import zlib
from collections import Counter

import numpy as np

from tessera.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    """Whether two different words are one edit apart, read side by side."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for d, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if v != w and one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], [ord(c) for c in v]), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def made():
    rnd = random.Random(13)
    base = ["".join(rnd.choice("abcéö") for _ in range(rnd.randint(4, 8))) for _ in range(60)]
    base += ["aaaaaa", "aaaaa", "aaaaaaa", "École", "ÉCOLE", "naïveté", "x×÷yz"]
    texts = []
    for i in range(400):
        words = []
        for _ in range(rnd.randint(0, 30)):
            w = base[int(len(base) * rnd.random() ** 2)]
            if rnd.random() < 0.3:
                k = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:k] + rnd.choice("abé") + w[k:], w[:k] + w[k + 1 :], w[:k] + rnd.choice("bcZ") + w[k + 1 :]])
            words.append(w.upper() if rnd.random() < 0.1 else w)
        texts.append((i, rnd.choice([" ", ", ", "1", "\n"]).join(words)))
    return texts


def test_same_as_comparing_all_pairs(spark):
    rows = made() + [(None, "Wordy wordy WORDY"), (None, None), (5000, ""), (5001, "wordx wordx wordx")] + [(77, "copied words copied words")] * 9
    rows += [(6000, "chain " * 3 + "chainx " * 7 + "chainxy " * 15)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int")
    got = sorted(tuple(r) for r in spelling.variants(df).collect())
    want = brute(rows)
    assert got == want
    assert any(f and r != f for _, f, r, *_ in want)  # chains of forms


def test_empty_tables_and_texts_without_letters(spark):
    df = spark.createDataFrame([(1, "12 34 ++"), (2, None)], "doc_id long, text string")
    assert spelling.variants(df).collect() == [] == spelling.variants(df.limit(0)).collect()
    assert dict(spelling.variants(df).dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_a_word_of_many_characters(spark):
    long = "ab" * 30_000
    rows = [(i, f"{long} {long}x") for i in range(4)] + [(9, long.replace("a", "c", 1))] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n_near for r in spelling.variants(df).collect()}
    assert len(got) == 3 and sorted(got.values()) == [1, 1, 2]


def test_every_candidate_once():
    full = np.full(1 << 10, 255, np.uint8)  # a filter that holds everything
    alphabet = np.frombuffer(b"abc", np.uint8)
    for word in (b"a", b"aab", b"abcca", b"zz"):
        got = [c for w, c in spelling.edits([word], alphabet, full)]
        letters = [bytes([c]) for c in b"abc"]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters if c != word[i : i + 1]}
        want |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        assert len(got) == len(set(got)) and set(got) == want - {word}
