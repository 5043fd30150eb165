"""Runs of words against a plain search over all periods."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import runs
from ebbtide.llm.queries import QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, shortest=12):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        same = np.array([words[i] == words[i - p] for i in range(p, n)] + [False])
        edges = np.flatnonzero(np.diff(np.r_[False, same]))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + p >= max(shortest, 2 * p):
                found.setdefault((a, b + p), p)
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(words, found):
    dropped = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def texts_with_repeats(rnd, n):
    for _ in range(n):
        size, letters = rnd.randrange(0, 140), rnd.choice([1, 2, 2, 3, 5, 60])
        words = [rnd.randrange(letters) for _ in range(size)]
        if size and rnd.random() < 0.5:
            a = rnd.randrange(size)
            p = rnd.randrange(1, max(2, (size - a) // 2 + 1))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        yield words


@pytest.mark.parametrize("step", [1, 5, 1000])
def test_appending_in_any_steps(step):
    rnd = random.Random(step)
    for words in texts_with_repeats(rnd, 150):
        shortest, catcher, i = rnd.choice([7, 8, 12, 20]), None, 0
        catcher = runs.RunCatcher(shortest)
        while i < len(words):
            size = rnd.randrange(1, step + 1)
            catcher.append(np.array(words[i : i + size]))
            i += size
        got = [(a, b - a, p) for a, b, p in catcher.runs().tolist()]
        assert got == plain_runs(words, shortest)


def test_a_run_is_known_as_soon_as_it_is_there():
    catcher = runs.RunCatcher()
    seen = []
    for word in [7, *[1, 2, 3, 4, 5, 6] * 3, 9]:
        catcher.append(np.array([word]))
        seen.append(catcher.runs().tolist())
    assert seen[11] == [] and seen[12] == [[1, 13, 6]] and seen[-1] == [[1, 19, 6]]


def test_names_that_collide_are_drawn_anew(monkeypatch):
    plain = runs.mix

    def mix(x):
        return plain(x) % np.uint64(3) if mix.weak else plain(x)

    mix.weak = True
    first = runs.RunCatcher.__init__

    def init(self, shortest=12, seed=0):
        mix.weak = seed == 0
        first(self, shortest, seed)

    monkeypatch.setattr(runs, "mix", mix)
    monkeypatch.setattr(runs.RunCatcher, "__init__", init)
    words = [random.Random(3).randrange(9) for _ in range(300)] + [1, 2, 3, 4, 5] * 6
    assert [(a, b - a, p) for a, b, p in runs.runs_of(np.array(words)).tolist()] == plain_runs(words)
    assert not mix.weak


def test_time_grows_with_the_text():
    def seconds(n):
        started = time.process_time()
        for words in (np.zeros(n, int), (np.arange(n) % 101 != 0).astype(int)):
            runs.runs_of(words)
        return time.process_time() - started

    seconds(1 << 12)
    assert seconds(1 << 17) < 16 * max(seconds(1 << 14), 0.05)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "a " * 12), (5, "a " * 12), (6, "a b " * 6), (None, "é ü x " * 9),
       (7, "a " * 11), (8, "long words " * 20_000 + "end"), (9, "y" * 100_000)]


def test_frames(spark):
    rnd = random.Random(2)
    rows = ODD + [(100 + i, " ".join(map(str, w))) for i, w in enumerate(texts_with_repeats(rnd, 80))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({c: F.lit(1) for c in ("runs", "collapsed", "n_words", "start")})
    want = []
    for doc, text in rows:
        words = brute.words(text)
        found = [(0, 40_000, 2)] if doc == 8 else plain_runs(words)
        want.append((doc, len(words), found, " ".join(kept_words(words, found))))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert runs.find_runs(df.where("doc_id < 0")).collect() == []


def test_query(spark):
    want = []
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    for doc, text in docs:
        words = brute.words(text)
        h, n = zlib.crc32(str(doc).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        # Periods of more than half of a plain text of this table are not looked for word by word.
        found = plain_runs(words) if n < 3000 else [
            (a, b - a, p) for a, b, p in runs.runs_of(np.unique(words, return_inverse=True)[1]).tolist()]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        digest = hashlib.sha256("".join(f"{a},{b},{p}\n" for a, b, p in found).encode()).hexdigest()
        kept = hashlib.sha256(" ".join(kept_words(words, found)).encode()).hexdigest()
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc, len(found), *longest, digest, kept))
    rows = QUERIES["op11_periodic_runs"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert any(r.n_runs for r in rows) and not all(r.n_runs for r in rows)
