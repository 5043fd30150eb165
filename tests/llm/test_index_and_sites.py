"""The digest index across openings, and posteriors of sites against a plain version."""

import random
import sys
import types

import numpy as np
import pytest

from ebbtide.llm import exact_dedup, quality


def test_an_index_is_reopened_with_its_own_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(i, f"text {i % 150}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = exact_dedup.DigestIndex.open(spark, path, 4)
    assert exact_dedup.deduplicate(df, first, "a").where("kept").count() == 150
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        exact_dedup.DigestIndex.open(spark, path, 8)
    again = exact_dedup.DigestIndex.open(spark, path + "/")
    assert (again.buckets, again.table) == (4, first.table)
    later = spark.createDataFrame([(1000 + i, f"text {i}") for i in range(160)], "doc_id long, text string")
    assert exact_dedup.deduplicate(later, again, "b").where("kept").count() == 10
    assert again.read().count() == 160


def plain_strength(n, s, mean):
    at = n > 1
    p = s / n
    weight = n[at].sum()
    if not weight:
        return 10.0
    spread, noise = (n * (p - mean) ** 2)[at].sum(), (mean * (1 - mean) * np.ones(len(n)))[at].sum()
    between, most = max((spread - noise) / weight, 0), noise / len(n)
    return min(max(most / between - 1, 1), 1e4) if between > 0 else 1e4


def plain_posteriors(rows, base):
    """``rows``: host, path, ratio; a document's site is judged by its other documents."""
    ratio = np.array([r[2] for r in rows])
    own = 1 / (1 + np.exp(-(base + ratio)))
    hosts, paths = [r[0] for r in rows], [r[:2] for r in rows]
    h = {k: [np.sum([x == k for x in hosts]), sum(o for x, o in zip(hosts, own) if x == k)] for k in set(hosts)}
    s = {k: [np.sum([x == k for x in paths]), sum(o for x, o in zip(paths, own) if x == k)] for k in set(paths)}
    p = min(max(own.mean(), 1e-6), 1 - 1e-6)
    n, total = np.array(list(h.values())).T
    outer = plain_strength(n, total, p)
    mean = {k: (outer * p + v[1]) / (outer + v[0]) for k, v in h.items()}
    n, total = np.array(list(s.values())).T
    inner = plain_strength(n, total, np.array([mean[k[0]] for k in s]))
    out = []
    for (host, path, r), o in zip(rows, own):
        up = (outer * p + h[host][1] - o) / (outer + h[host][0] - 1)
        site = (inner * up + s[host, path][1] - o) / (inner + s[host, path][0] - 1)
        site = min(max(site, 1e-9), 1 - 1e-9)
        out.append(1 / (1 + np.exp(-(np.log(site / (1 - site)) + r))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_posteriors_leave_out_the_own_document(spark, seed):
    rnd = random.Random(seed)
    rows = [(h, p, rnd.gauss(3 if h == "bad" else -1, 2)) for h in ("good", "bad", "mid") for p in "abc" for _ in range(3)]
    rows += [("lone", "only", 3.0), ("", "", -2.0), ("mid", "", 0.0)]
    frame = spark.createDataFrame(
        [(i, 0, h, p, r, -r) for i, (h, p, r) in enumerate(rows)], "doc_id long, text_key long, host string, path string, low double, toxic double"
    ).repartition(3)
    bases = {"low": -3.0, "toxic": -1.0}
    judged = frame.join(quality.beliefs(frame, bases), ["host", "path"])
    got = sorted(judged.select("doc_id", *(quality.posterior(t, bases[t]).alias(t) for t in quality.TRAITS)).collect())
    assert len(got) == len(rows)
    for trait, sign in (("low", 1), ("toxic", -1)):
        want = plain_posteriors([(h, p, sign * r) for h, p, r in rows], bases[trait])
        assert [r[trait] for r in got] == pytest.approx(want, abs=1e-9)


def test_a_lone_document_does_not_testify_for_itself(spark):
    rows = [(i, 0, "big", "p", -4.0, 0.0) for i in range(50)] + [(99, 0, "lone", "only", 3.0, 0.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text_key long, host string, path string, low double, toxic double")
    bases = {"low": -3.0, "toxic": -3.0}
    judged = frame.join(quality.beliefs(frame, bases), ["host", "path"]).where("doc_id = 99")
    assert judged.select(quality.posterior("low", -3.0)).first()[0] < 0.5


def test_errors_inside_the_subpackage_are_not_hidden(monkeypatch):
    import __spark_entry__ as entry

    assert "op1_exact_dedup" in entry.queries()
    monkeypatch.setitem(sys.modules, "ebbtide.llm.queries", types.ModuleType("ebbtide.llm.queries"))
    with pytest.raises(ImportError):
        entry.queries()
