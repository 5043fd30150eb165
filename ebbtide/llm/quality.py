"""Document filtering by hierarchical empirical Bayes: evidence of the text, shrunk beliefs about its host and path.

For each trait (low quality, toxic) a document has a log likelihood ratio from its text alone.  Hosts and the paths
below them have beliefs about how common the trait is there: Beta posteriors from grouped sums of the documents' own
probabilities, a path shrunk toward its host and a host toward the corpus, by as much as the spread between sites
warrants.  The posterior odds of a document are the odds at its path times its likelihood ratio.

The text's evidence is fitted on labelled rows: a bounded sample of them (the ``sample`` smallest hashes of ids).
Words that the sample shows to go with a trait beyond chance are weighed by their shrunk log odds; the form of the text
(symbols, capitals, repetition, length of words) is weighed by a ridge-penalised logistic regression.  Everything else
covers all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import words as W
from ebbtide.llm.scratch import keep_rows, require, store, text_key

SAMPLE = 20_000
TRAITS = ("low", "toxic")
FORM = ("decorated", "symbols", "capitals", "repeated", "adjacent", "letters")
# Lengths in bytes at which the beginnings of longer words are looked at, so that inflected forms share their evidence.
STEMS = (4, 5)
RUN = 5
MOST = 12.0
KEYS = "doc_id long, text_key long"
RATIOS = f"{KEYS}, host string, path string, low double, toxic double"


def _tokens(data: np.ndarray, offsets: np.ndarray) -> W.Words:
    """Runs of ASCII letters, digits and bytes of other alphabets, A-Z lowered."""
    kept = np.zeros(256, bool)
    kept[48:58] = kept[65:91] = kept[97:123] = kept[128:] = True
    return W.split_words(np.where(kept[data], data, np.uint8(0x20)), offsets, lower=True)


def lexical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and the document of each; with repeats."""
    words = _tokens(data, offsets)
    owner = words.documents()
    keys, owners = [W.word_hashes(words)], [owner]
    for size in STEMS:
        longer = words.ends - words.starts > size
        cut = W.Words(words.data, words.starts[longer], words.starts[longer] + size, words.offsets)
        keys.append(W.mix(W.word_hashes(cut) + W.U64(size)))
        owners.append(owner[longer])
    return np.concatenate(keys), np.concatenate(owners)


def _share(hits: np.ndarray, owner: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return np.bincount(owner[hits], minlength=len(totals)) / np.maximum(totals, 1)


def form(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``FORM`` of each document, numbers from 0 to about 1 that do not depend on the length of the text."""
    words = W.split_words(data, offsets)
    owner, counts = words.documents(), words.counts
    letter, upper, lower = (np.zeros(256, bool) for _ in range(3))
    upper[65:91] = lower[97:123] = True
    letter |= upper | lower
    letter[48:58] = letter[128:] = True

    def inside(kind: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(kind[data])]
        return sums[words.ends] - sums[words.starts]

    length = words.ends - words.starts
    letters, uppers, lowers = inside(letter), inside(upper), inside(lower)
    mark = ~letter[data] if len(data) else np.zeros(0, bool)
    decorated = (length > 2) & mark[words.ends - 1] & mark[words.ends - 2] if len(length) else np.zeros(0, bool)
    hashes = W.word_hashes(words)
    same = np.r_[False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])] if len(hashes) else np.zeros(0, bool)
    starts = np.flatnonzero(W.window_starts(words, 3))
    runs, at = W.window_hashes(hashes, 3)[starts], owner[starts]
    order = np.lexsort((runs, at))
    again = np.r_[False, (runs[order][1:] == runs[order][:-1]) & (at[order][1:] == at[order][:-1])][: len(order)]
    repeated = _share(again, at[order], np.bincount(at, minlength=len(counts)))
    mean = np.bincount(owner, weights=letters, minlength=len(counts)) / np.maximum(counts, 1)
    return np.stack(
        [
            _share(decorated, owner, counts),
            _share(letters == 0, owner, counts),
            _share((uppers > 1) & (lowers == 0), owner, counts),
            repeated,
            _share(same, owner, counts),
            np.log1p(mean) / 5,
        ],
        1,
    )


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method with halved steps; the mean of the loss plus the penalty."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.r_[np.full(x.shape[1] - 1, ridge / max(len(x), 1) ** 0.5), 1e-9]
    beta = np.zeros(x.shape[1])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5 * penalty @ (b * b))

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - y) / len(x) + penalty * beta
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x / len(x) + np.diag(penalty + 1e-9), gradient)
        size, now = 1.0, loss(beta)
        while size > 1e-4 and loss(beta - size * step) > now:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return beta


@dataclass
class Trait:
    """How a text speaks for a trait: weights of words, of the form, and of the sum of the words."""

    base: float
    keys: np.ndarray
    weights: np.ndarray
    beta: np.ndarray

    def ratios(self, data: np.ndarray, offsets: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of each document, kept within ``MOST``; 0 for a text without words."""
        n = len(offsets) - 1
        if not len(self.beta):
            return np.zeros(n)
        x = np.c_[shape, word_sums(data, offsets, self.keys, self.weights)]
        ratio = x @ self.beta[:-1] + self.beta[-1] - self.base
        return np.where(W.split_words(data, offsets).counts > 0, np.clip(ratio, -MOST, MOST), 0.0)


def word_sums(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of the distinct known words and beginnings of each document, and whether there are any."""
    n = len(offsets) - 1
    out = np.zeros((n, 2))
    if len(keys):
        found, owner = lexical(data, offsets)
        # Most words are none of the known ones; a table of the top bits sorts them out.
        likely = np.zeros(1 << 16, bool)
        likely[(keys >> W.U64(48)).astype(np.int64)] = True
        rows = np.flatnonzero(likely[(found >> W.U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, found[rows]), len(keys) - 1)
        hit = keys[at] == found[rows]
        pairs = np.unique(owner[rows][hit] * len(keys) + at[hit])
        out[:, 0] = np.bincount(pairs // len(keys), weights=weights[pairs % len(keys)], minlength=n)
        out[:, 1] = out[:, 0] > 0
    return out


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _parts(array: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = W.flat(array)
    for first, last in W.pieces(offsets):
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]


def _least_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two min-hashes of the runs of ``RUN`` words of each text; near copies have at least one of them in common."""
    for batch in batches:
        for first, last, data, offsets in _parts(batch.column(1)):
            words = W.split_words(data, offsets, lower=True)
            starts = np.flatnonzero(W.window_starts(words, RUN))
            runs, owner = W.window_hashes(W.word_hashes(words), RUN)[starts], words.documents()[starts]
            own = batch.column(0).slice(first, last - first).to_numpy()
            columns = []
            for salt in W.BASES:
                least = W.mix(own.view(W.U64) ^ W.U64(salt))  # a text without runs is like no other
                long = np.unique(owner)
                if len(long):
                    begins = np.searchsorted(owner, long)
                    least[long] = np.minimum.reduceat(W.mix(runs ^ W.U64(salt)), begins)
                columns.append(pa.array(W.signed(least)))
            rest = [batch.column(i).slice(first, last - first) for i in range(1, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), *rest, *columns], ["text_key", "text", "low", "toxic", "run1", "run2"]
            )


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Texts of at most ``sample`` labelled ids with their traits; copies and near copies of a text speak once.

    The ids are so few that they are sent to the readers of the texts.
    """
    chosen = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("low").alias("low"), F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    rows = rows.select("text_key", "text", "low", "toxic").mapInArrow(
        _least_runs, "text_key long, text string, low int, toxic int, run1 long, run2 long"
    )
    for key in ("run1", "run2"):
        one = F.min(F.struct("text_key", "text", "low", "toxic", "run2")).alias("one")
        rows = rows.groupBy(key).agg(one).select("one.*")
    return rows


def _explode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low, toxic = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for first, _, data, offsets in _parts(batch.column(0)):
            keys, owner = lexical(data, offsets)
            order = np.lexsort((keys, owner))
            keys, owner = keys[order], owner[order]
            new = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])][: len(keys)]
            keys, owner = keys[new], owner[new] + first
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(keys)), pa.array(low[owner]), pa.array(toxic[owner])], ["key", "low", "toxic"]
            )


def fit(sample: DataFrame, strength: float = 2.0) -> dict[str, Trait]:
    """Traits from a bounded labelled sample.

    A word counts if the share of the trait among its documents is so high that of all words of the sample less than one
    in e^3 would get there by chance (Chernoff's bound); its weight is its log odds against the base rate, shrunk by
    ``strength`` documents of the base rate.  A trait that the sample never or always shows gives no evidence.
    """
    sample = store(sample, "labelled")
    n, *hits = sample.agg(F.count(F.lit(1)), *(F.sum(t) for t in TRAITS)).first()
    empty = np.zeros(0)
    rates = {t: (h or 0) / n if n else 0.0 for t, h in zip(TRAITS, hits)}
    words = sample.select("text", "low", "toxic").mapInArrow(_explode_words, "key long, low int, toxic int")
    counts = store(
        words.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *(F.sum(t).alias(t) for t in TRAITS)).where("n > 2"), "words"
    )
    chance = math.log(max(counts.count(), 1)) + 3
    weights = {}
    for trait, p in rates.items():
        if not 0 < p < 1:
            weights[trait] = (empty.astype(W.U64), empty)
            continue
        q = F.col(trait) / F.col("n")
        gain = q * F.log(q / p) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
        found = counts.where((q > max(0.5, p)) & (F.col("n") * gain > chance)).select("key", "n", trait).toArrow()
        keys = found.column("key").to_numpy().view(W.U64)
        order = np.argsort(keys)
        total, with_it = found.column("n").to_numpy()[order], found.column(trait).to_numpy()[order]
        share = (with_it + strength * p) / (total + strength)
        weights[trait] = keys[order], np.log(share / (1 - share)) - _logit(p)
    rows = sample.select("text", "low", "toxic")
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in _parts(batch.column(0)):
                shape = form(data, offsets)
                x = np.c_[shape, *(word_sums(data, offsets, *shared.value[t]) for t in TRAITS)]
                part = [batch.column(i).slice(first, last - first) for i in (1, 2)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())
                )
                yield pa.RecordBatch.from_arrays([lists, *part], ["x", "low", "toxic"])

    # At most ``sample`` short rows.
    table = rows.mapInArrow(describe, "x array<double>, low int, toxic int").toArrow()
    x = np.array(table.column("x").combine_chunks().flatten()).reshape(n, -1) if n else np.zeros((0, 0))
    out = {}
    for i, trait in enumerate(TRAITS):
        p = rates[trait]
        keys, weight = weights[trait]
        if not 0 < p < 1:
            out[trait] = Trait(0.0, keys, weight, empty)
            continue
        own = np.c_[x[:, : len(FORM)], x[:, len(FORM) + 2 * i : len(FORM) + 2 * i + 2]]
        out[trait] = Trait(_logit(p), keys, weight, logistic(own, table.column(trait).to_numpy().astype(float)))
    return out


def evidence(docs: DataFrame, traits: dict[str, Trait]) -> DataFrame:
    """Log likelihood ratios of all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(traits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in _parts(batch.column(4)):
                shape = form(data, offsets)
                ratios = [pa.array(shared.value[t].ratios(data, offsets, shape)) for t in TRAITS]
                keys = [batch.column(i).slice(first, last - first) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*keys, *ratios], ["doc_id", "text_key", "host", "path", *TRAITS])

    return docs.select("doc_id", "text_key", "host", "path", "text").mapInArrow(run, RATIOS)


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (1 + F.exp(-z))


def _strength(groups: DataFrame, mean: Column | float) -> float:
    """How many documents the prior of a level is worth: by moments of the groups' means around their prior mean."""
    mean = F.lit(mean) if isinstance(mean, float) else mean
    size, p = F.col("n"), F.col("s") / F.col("n")
    spread, noise, weight = groups.where("n > 1").agg(
        F.sum(size * (p - mean) * (p - mean)), F.sum(mean * (1 - mean)), F.sum(size)
    ).first()
    if not weight:
        return 10.0
    # Between-group variance above what groups of this size show by chance, relative to the largest there can be.
    between, most = max((spread - noise) / weight, 0.0), noise / max(groups.count(), 1)
    return float(min(max(most / between - 1, 1.0) if between > 0 else 1e4, 1e4))


def _own(trait: str, base: float) -> Column:
    """A document's probability by the corpus and its own text."""
    return _sigmoid(F.lit(base) + F.col(trait))


def beliefs(ratios: DataFrame, bases: dict[str, float]) -> DataFrame:
    """What ``posterior`` needs of each ``host`` and ``path``: rows, sums of the documents' own probabilities, strengths.

    One grouped sum per path (pre-aggregated before the shuffle), then sums of those per host; hosts are shrunk toward
    the corpus and paths toward their host.  ``site_<trait>`` is the probability at a path with all its documents.
    """
    own = [F.sum(_own(t, bases[t])).alias(f"{t}_sum") for t in TRAITS]
    paths = store(ratios.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *own), "paths")
    sums = [F.sum(f"{t}_sum").alias(f"{t}_host_sum") for t in TRAITS]
    hosts = store(paths.groupBy("host").agg(F.sum("n").alias("host_n"), *sums), "hosts")
    n, *totals = hosts.agg(F.sum("host_n"), *(F.sum(f"{t}_host_sum") for t in TRAITS)).first()
    both = store(paths.join(hosts, "host"), "sites")
    out = both
    for trait, total in zip(TRAITS, totals):
        p = min(max((total or 0.0) / (n or 1), 1e-6), 1 - 1e-6)
        worth = _strength(hosts.select(F.col("host_n").alias("n"), F.col(f"{trait}_host_sum").alias("s")), p)
        mean = (F.lit(worth * p) + F.col(f"{trait}_host_sum")) / (F.lit(worth) + F.col("host_n"))
        inner = _strength(both.select("n", F.col(f"{trait}_sum").alias("s"), mean.alias("mean")), F.col("mean"))
        known = {"p": p, "host_worth": worth, "worth": inner}
        out = out.withColumns({f"{trait}_{k}": F.lit(float(v)) for k, v in known.items()})
        site = (F.lit(float(inner)) * mean + F.col(f"{trait}_sum")) / (F.lit(float(inner)) + F.col("n"))
        out = out.withColumn(f"site_{trait}", site)
    return out


def posterior(trait: str, base: float) -> Column:
    """Probability of the trait by text and site, over rows of ratios joined with their ``beliefs``.

    The site testifies by its other documents: a row's own probability and count are taken out of the sums of its path
    and host, as its text already counts by its ratio.
    """

    def of(name: str) -> Column:
        return F.col(f"{trait}_{name}")

    own = _own(trait, base)
    host = (of("host_worth") * of("p") + of("host_sum") - own) / (of("host_worth") + F.col("host_n") - 1)
    site = (of("worth") * host + of("sum") - own) / (of("worth") + F.col("n") - 1)
    site = F.least(F.greatest(site, F.lit(1e-9)), F.lit(1 - 1e-9))
    return _sigmoid(F.log(site / (1 - site)) + F.col(trait))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    threshold: float = 0.5,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``p_low``, ``p_toxic``, ``kept``, ``text_key`` of each row.

    ``labels``: ``doc_id``, ``quality`` (1 good), ``toxic`` (1 toxic); of repeated labels the worse counts, a null is no
    finding.  ``kept``: both posteriors are below ``threshold``.  Null and empty texts give no evidence and are judged
    by their site alone; null hosts and paths are sites of their own.  Without labels of both kinds a trait is not
    judged and rejects nothing.  Rows with a null or repeated id are judged one by one.

    The sample is sent to the readers (``sample`` ids); the table of sites may be of any size and is joined with narrow
    rows, both from written tables, so that a site with a third of all rows can be split.
    """
    require(docs, id_col, text_col)
    require(labels, "doc_id", "quality", "toxic")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_key(text_col).alias("text_key"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)).alias("low"),
        F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)).alias("toxic"),
    )
    traits = fit(labelled_sample(rows.select("doc_id", "text_key", "text"), marks, sample))
    ratios = store(evidence(rows, traits), "ratios")
    bases = {t: traits[t].base if len(traits[t].beta) else -MOST for t in TRAITS}
    sites = store(beliefs(ratios, bases), "beliefs")
    judged = ratios.join(sites, ["host", "path"])
    found = {t: posterior(t, bases[t]) if len(traits[t].beta) else F.lit(0.0) for t in TRAITS}
    out = judged.select("doc_id", *(found[t].alias(f"p_{t}") for t in TRAITS), "text_key")
    kept = (F.col("p_low") < threshold) & (F.col("p_toxic") < threshold)
    return out.select("doc_id", "p_low", "p_toxic", kept.alias("kept"), "text_key")


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **settings) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns."""
    id_col, text_col = settings.get("id_col", "doc_id"), settings.get("text_col", "text")
    verdict = store(classify(docs, labels, host, path, **settings).where("kept"), "good")
    return keep_rows(docs, verdict, id_col, text_col)
