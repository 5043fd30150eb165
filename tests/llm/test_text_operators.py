"""Operators on texts against plain versions, with nulls, ties, repeated rows, long texts and clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import chat, exact_dedup, jaccard, mixing, quality, substrings, words
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rnd, pool, sizes=(1, 2, 5, 40), edits=(0, 1, 1, 2, 3)):
    """Families of near copies, passages that many rows share, and the odd cases."""
    rows = [(1, None), (2, None), (3, ""), (4, " \n"), (5, "A b"), (6, "a B"), (7, "a"), (None, "a b"), (8, "x y z")]
    rows += [(None, "lonely row without an id here"), (None, "q " * 20), (10, "q " * 30), (10, "q " * 13), (11, "é ü " * 40)]
    rows += [(5, "another text under an id that is taken"), (12, "long " * 3000), (13, "y" * 100_000)]
    n = 100
    for _ in range(8):
        base = [rnd.choice(pool) for _ in range(rnd.choice([20, 60, 120]))]
        for _ in range(rnd.choice(sizes)):
            text = list(base)
            for _ in range(rnd.choice(edits)):
                text[rnd.randrange(len(text))] = rnd.choice(pool)
            rows.append((n, rnd.choice([" ", "\n"]).join(text)))
            n += 1
    passage = " ".join(rnd.choice(pool) for _ in range(30))
    for _ in range(40):
        rows.append((n, passage + " " + " ".join(rnd.choice(pool) for _ in range(rnd.choice([1, 3, 20])))))
        n += 1
    rows += rows[-3:]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return edited(random.Random(5), [f"w{i}" for i in range(400)] + ["The", "der", "é"])


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Columns with names that the operators use inside.
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("order", "digest", "text_key", "node", "kept", "n_tokens", "ids", "label")})


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_near_duplicates(docs, rows, size, percent):
    got = jaccard.near_duplicates(docs, size, percent).select("doc_id", "n_shingles", "component_id")
    assert sorted_rows(got) == brute.components(rows, size, percent)


def test_small_regions_are_split_again(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_REGION", 3)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    got = jaccard.near_duplicates(docs, 3, 85).select("doc_id", "n_shingles", "component_id")
    assert sorted_rows(got) == brute.components(rows, 3, 85)


@pytest.fixture(scope="module")
def template(spark):
    """Many copies of a template with edits of their own, some just under the threshold, as rows and as a frame."""
    rnd = random.Random(11)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for n in range(60):
        text = list(base)
        for i in rnd.sample(range(80), rnd.choice([1, 2, 3, 4])):
            text[i] = f"e{rnd.randrange(30)}"
        rows.append((n, " ".join(text)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def forced_to_templates(monkeypatch):
    """Small regions, so that groups of near copies reach the last step; notes the sizes of compared regions and pairs."""
    sizes, pairs = [], {}
    apart, measure = jaccard._Join.apart, jaccard._Join.measure

    def sized(self, regions):
        sizes.extend(r["count"] for r in regions.groupBy("region").count().collect())
        return apart(self, regions)

    def named(self, found, name):
        pairs[name] = pairs.get(name, 0) + found.count()
        return measure(self, found, name)

    monkeypatch.setattr(jaccard, "SMALL_REGION", 3)
    monkeypatch.setattr(jaccard._Join, "apart", sized)
    monkeypatch.setattr(jaccard._Join, "measure", named)
    return sizes, pairs


def test_regions_that_pivots_do_not_part(template, monkeypatch):
    rows, docs = template
    sizes, pairs = forced_to_templates(monkeypatch)
    got = jaccard.near_duplicates(docs, 3, 90).select("doc_id", "n_shingles", "component_id")
    assert sorted_rows(got) == brute.components(rows, 3, 90)
    assert "template-distances" in pairs and max(sizes) <= 3


def test_overlapping_regions_list_a_document_once(spark, monkeypatch):
    rnd = random.Random(7)
    base = [f"t{i}" for i in range(100)]
    rows = []
    for doc in range(300):
        text = list(base)
        for i in rnd.sample(range(100), rnd.choice((1, 2, 3, 4))):
            text[i] = f"e{rnd.randrange(30)}"
        rows.append((doc, " ".join(text)))
    forced_to_templates(monkeypatch)
    stored, store = {}, jaccard.store

    def kept(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(jaccard, "store", kept)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), 3, 90)
    assert sorted_rows(got.select("doc_id", "n_shingles", "component_id")) == brute.components(rows, 3, 90)
    elements = stored["elements"]
    assert elements.count() == elements.select("node", "shingle").distinct().count() > 0


@pytest.mark.parametrize("n, edits, own", [(200, (1, 2, 3, 4), 30), (1500, (2, 3), 10**9), (600, (2, 2, 3), 40)])
def test_groups_of_near_copies_cost_pairs_in_proportion(spark, monkeypatch, n, edits, own):
    rnd = random.Random(n)
    base = [f"t{i}" for i in range(100)]
    rows = []
    for doc in range(n):
        text = list(base)
        for i in rnd.sample(range(100), rnd.choice(edits)):
            text[i] = f"e{rnd.randrange(own)}"
        if rnd.random() < 0.2:
            text = text[: -rnd.randrange(1, 12)]
        rows.append((doc, " ".join(text)))
    _, pairs = forced_to_templates(monkeypatch)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), 3, 90)
    assert sorted_rows(got.select("doc_id", "n_shingles", "component_id")) == brute.components(rows, 3, 90)
    assert pairs.get("template-distances", 0) <= 10 * n


def test_a_full_sketch_leaves_the_order_to_exact_counts(spark, monkeypatch):
    rnd = random.Random(3)
    common = [f"of the kind {i}" for i in range(4)]
    rows = []
    for n in range(80):
        words_ = [f"u{n}x{i}" for i in range(20)]
        rows.append((n, " ".join(words_[:10] + common + words_[10:])))
    rows += [(100 + n, f"{text} end{n}") for n, text in rows[:5]]
    rnd.shuffle(rows)
    measured = []
    measure = jaccard._Join.measure

    def named(self, pairs, name):
        measured.append((name, pairs.count()))
        return measure(self, pairs, name)

    gather = jaccard.Sketch.gather

    def full(self, df, keys_of):
        gather(self, df, keys_of)
        for bits in self.reached.values():
            bits[:] = 255
        return self

    # A sketch with far too few counters calls every shingle shared and frequent.
    monkeypatch.setattr(jaccard.Sketch, "gather", full)
    monkeypatch.setattr(jaccard, "SMALL_REGION", 3)
    monkeypatch.setattr(jaccard._Join, "measure", named)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 80).select("doc_id", "n_shingles", "component_id")
    assert sorted_rows(got) == brute.components(rows, 3, 80)
    # Documents that share the common words alone are not compared.
    assert {n for n, _ in measured} == {"distances", "window-pairs"}
    assert sum(pairs for _, pairs in measured) <= 10


def swapped(depth=10):
    """Two different words of 1,024 letters that polynomials modulo 2^64 cannot tell apart."""
    a, b = "a", "b"
    for _ in range(depth):
        a, b = a + b, b + a
    return a, b


def test_words_that_differ_in_a_doubling_pattern_are_different(spark):
    a, b = swapped()
    assert len(a) == 1024 and a != b
    rest = " ".join(f"c{i}" for i in range(12))
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a * 4} {rest} {a[:1024]}"), (4, a), (5, b)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted_rows(substrings.remove_repeats(df)) == brute.without_repeats(rows)
    got = jaccard.near_duplicates(df, 3, 90).select("doc_id", "n_shingles", "component_id")
    assert sorted_rows(got) == brute.components(rows, 3, 90)


def test_word_hashes_follow_the_words():
    rnd = random.Random(1)
    pool = ["".join(rnd.choice("ab") for _ in range(n)) for n in (1, 7, 8, 9, 15, 16, 17, 255, 256, 257, 300) for _ in range(3)]
    texts = [" ".join(rnd.choice(pool) for _ in range(40)) for _ in range(30)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    split = words.split_words(data, offsets)
    for base in words.BASES:
        hashes = words.word_hashes(split, base).tolist()
        found = {}
        for word, h in zip([w for t in texts for w in t.split()], hashes):
            assert found.setdefault(word, h) == h
        assert len(set(found.values())) == len(found)


def test_one_of_each_component_is_kept(docs):
    found = jaccard.near_duplicates(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), 5, 80)
    kept = found.where("kept").collect()
    assert sorted(r.doc_id for r in kept) == sorted({r.component_id for r in found.collect()})


def test_repeats(docs, rows):
    assert sorted_rows(substrings.remove_repeats(docs)) == brute.without_repeats(rows)
    assert sorted_rows(substrings.remove_repeats(docs, window=5, anchor=3)) == brute.without_repeats(rows, 5)


def test_exact_dedup_in_batches(spark, docs, rows, tmp_path):
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), 4)
    first = docs.where("doc_id < 110")
    exact_dedup.deduplicate(first, index, "one").collect()
    count = index.read().count()
    exact_dedup.deduplicate(first, index, "one").collect()
    assert index.read().count() == count
    again = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), 4)
    assert again.read().count() == count
    got = exact_dedup.deduplicate(docs, again, "two").collect()
    assert len(got) == len(rows)
    old = {r.text_sha256 for r in exact_dedup.deduplicate(first, again, "three").collect()}
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    for digest, members in groups.items():
        ids = [m.doc_id for m in members if m.doc_id is not None]
        assert {m.group_size for m in members} == {len(members)}
        assert not any(m.kept for m in members) if digest in old else any(m.kept for m in members)
        if digest not in old:
            assert {m.keep_id for m in members} == {min(ids) if ids else None}


def test_exact_dedup_keeps_one_row_of_each_group(spark, docs):
    kept = exact_dedup.keep_first(docs, exact_dedup.temporary_index(spark), "all")
    assert kept.columns == docs.columns
    texts = [" ".join((r.text or "").replace("\n", " ").split(" ")) for r in kept.collect()]
    assert len(texts) == len(set(texts))


def test_the_join_of_the_index_shuffles_only_the_batch(spark, docs):
    index = exact_dedup.temporary_index(spark)
    exact_dedup.deduplicate(docs, index, "one").collect()
    groups = docs.select(exact_dedup.digest(F.col("text")).alias("digest")).distinct()
    plan = groups.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in physical and "Bucketed: true" in physical


@pytest.mark.parametrize("operator", [
    lambda d: jaccard.near_duplicates(d), substrings.remove_repeats,
    lambda d: exact_dedup.deduplicate(d, exact_dedup.temporary_index(d.sparkSession), "x"),
    lambda d: mixing.mixture(d, {"topic": F.lit("x")}, {"topic": 1.0})[0],
])
def test_no_rows(docs, operator):
    assert operator(docs.where("doc_id < 0")).collect() == []


def test_missing_columns_are_named(docs):
    with pytest.raises(ValueError, match="text"):
        jaccard.near_duplicates(docs.drop("text"))


def test_word_hashes_depend_on_bytes_alone():
    import pyarrow as pa

    data, offsets = words.flat(pa.array(["a b  c\n d", None, "", "  x", "éa b c", "b", "\x0b", "tail "]))
    found = words.split_words(data, offsets)
    assert found.counts.tolist() == [4, 0, 0, 1, 3, 1, 0, 1]
    hashes = words.word_hashes(found)
    assert hashes[1] == hashes[6] == hashes[8] and len(set(hashes.tolist())) == 7


def test_chat_round_trip(spark):
    rows = [
        (-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
        (1, 0, "user", "a"), (1, 1, "user", "b</part>"), (1, 2, "assistant", "x\\b\n</turn>\n"), (1, 3, "assistant", ""),
        (1, None, "as:\n#", None), (None, 1, None, None), (2, 1, "assistant", "ééü\\\\l####"), (3, 0, "user", "z" * 50_000),
        (4, 0, "user", "twice"), (4, 0, "user", "twice"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(0))
    formatted = chat.format_conversations(df)
    for r in chat.parse_conversations(formatted).collect():
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert r.loss == [x[3] for x in own if x[2] == "assistant"]
        assert r.formatted.count("### ") == 1 + sum(a[2] != b[2] for a, b in zip(own, own[1:]))
    assert formatted.where("conv_id < -10").collect() == []


def test_chat_uses_no_python(spark, docs):
    df = docs.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text")
    plan = chat.summarise(chat.parse_conversations(chat.format_conversations(df)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_meets_its_targets(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rnd.integers(1, 40))), f"s{i % 7 % 3}", rnd.choice(["en", "de"]), rnd.choice(["x", "y"]))
            for i in range(3000)]
    rows += [(4000, None, None, "en", "x"), (4001, "", "s1", None, None), (None, "w w", "s1", "en", "x")]
    df = spark.createDataFrame([tuple(map(lambda v: v if v is None or isinstance(v, (str, int)) else str(v), r)) for r in rows],
                               "doc_id long, text string, source string, lang string, topic string")
    goal = spark.createDataFrame([("s0", 1.0), ("s1", 1.0), ("s2", 2.0), ("none", 5.0)], "source string, share double")
    dims = {c: F.col(c) for c in ("source", "lang", "topic")}
    decided, cells = mixing.mixture(df, dims, {"lang": 0.5, "topic": 0.0}, {"source": goal}, fraction=0.4)
    table = {(r.source, r.lang, r.topic): (r.tokens, r.weight, r.probability) for r in cells.collect()}
    # The same fit in numpy.
    keys = sorted(k for k in table)
    tokens = np.array([table[k][0] for k in keys])
    weight, total = tokens.copy(), tokens.sum()
    shares = [{"s0": 0.25, "s1": 0.25, "s2": 0.5}]
    all_tokens = {}
    for k, t in zip(keys, tokens):
        all_tokens[k[1]] = all_tokens.get(k[1], 0) + t
    root = {k: v**0.5 for k, v in all_tokens.items()}
    shares += [{k: v / sum(root.values()) for k, v in root.items()}, {"x": 0.5, "y": 0.5}]
    for _ in range(200):
        for axis, share in enumerate(shares):
            sums = {v: sum(w for k, w in zip(keys, weight) if k[axis] == v) for v in share}
            weight = np.array([w * share[k[axis]] / sums[k[axis]] for k, w in zip(keys, weight)])
    assert np.allclose([table[k][1] for k in keys], weight, rtol=1e-3)
    p = np.array([table[k][2] for k in keys])
    assert p.max() <= 1 and abs((p * tokens).sum() / total - 0.4) < 0.01
    rows = decided.collect()
    kept = sum(r.tokens for r in rows if r.kept)
    assert len(rows) == 3003 and abs(kept / total - 0.4) < 0.05
    assert all(r.kept == (r.chance < r.probability) for r in rows)
    assert sorted_rows(decided.select("row.doc_id", "kept")) == sorted_rows(decided.repartition(5).select("row.doc_id", "kept"))


def test_quality_without_labels_or_hosts(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, none, F.lit(None), F.lit(None)).collect()
    assert len(found) == len(rows) and all(r["kept"] for r in found)
    one = spark.createDataFrame([(100, 1, None), (101, None, 0), (101, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in quality.classify(docs, one, F.lit("h"), F.lit("p")).collect())


def test_sparse_sites_are_shrunk(spark):
    from ebbtide.llm.quality import beliefs

    rows = [("big", "big/a", 3.0)] * 900 + [("big", "big/b", -3.0)] * 900 + [("tiny", "tiny/a", 3.0)] + [("calm", "calm/a", -3.0)] * 900
    df = spark.createDataFrame([(h, p, z, z) for h, p, z in rows], "host string, path string, low double, toxic double")
    odds = {r.path: r.site_low for r in beliefs(df, {"low": 0.0, "toxic": 0.0}).collect()}
    assert odds["calm/a"] < odds["big/b"] < odds["tiny/a"] < odds["big/a"]


def test_rake_tells_when_targets_are_missed(spark):
    cells = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0)], "source string, lang string, tokens double")
    sources = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double")
    langs = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, share double")
    with pytest.warns(UserWarning, match="targets missed"):
        mixing.rake(cells, {"source": sources, "lang": langs}, rounds=2)
