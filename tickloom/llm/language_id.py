"""Language of texts from several kinds of evidence, fused by Bayes' rule.

* *Text*: a naive Bayes model of hashed byte trigrams of the letters, fitted on
  all labelled texts by grouped aggregation (counts per label and gram, a row per
  label). One more hypothesis is that the text is of *none* of the labels: its
  letters follow each other without any rule, each as often as in all labelled texts.
* *Declared markup language* and *address suffix*: how often each value goes with
  each language, counted over all rows by the text's own verdict, smoothed.
* *Host*: a prior per host, smoothed towards its domain's, and that towards all
  rows'. A row's own share is taken out of the counts of its host and domain.

The grouped tables hold a row per host, domain, suffix or declared value, and are
joined by shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrow import column, giving_back, packed, slices
from tickloom.llm.tables import written

GRAM_BITS = 14
# Labels whose counts a task holds before it hands them on.
HELD_LABELS = 128
# Chance beforehand that a text is of none of the labels, against one for each label; share of its letters that are any byte.
NONE_PRIOR, ANY_BYTE = 0.01, 0.02
# Counts added for each gram, dealt out as the background has the grams; grams a text counts for at most (they overlap and repeat, so they are no independent evidence).
GRAM_SMOOTHING, TEXT_WEIGHT, TEXT_GRAMS = 0.5, 0.3, 400.0
# Rows that a level of the host hierarchy, or a declared value or suffix, counts as having beforehand.
PRIOR_ROWS, VALUE_ROWS = 20.0, 5.0
LEAST_POSTERIOR = 0.5
CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams, and the text of each. Bytes that are no letters count as one kind of space."""
    bytes_ = np.where(_LETTER[data], _LOWER[data], np.uint8(32)).astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(bytes_) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = (bytes_[:-2] << np.uint32(16)) | (bytes_[1:-1] << np.uint32(8)) | bytes_[2:]
    whole = (text[:-2] == text[2:]) & ((bytes_[:-2] != 32) | (bytes_[1:-1] != 32)) & ((bytes_[1:-1] != 32) | (bytes_[2:] != 32))
    gram = (gram[whole] * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
    return gram.astype(np.int64), text[:-2][whole]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = packed(column(batch, "text"))
    for first, last in slices(offsets, CHUNK_BYTES):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def _background(letters: np.ndarray) -> np.ndarray:
    """Share of each hashed gram if every byte came by itself, as often as in ``letters`` (counts per byte)."""
    symbols = np.r_[32, np.unique(_LOWER[_LETTER])]
    counts = letters[symbols] / max(letters.sum(), 1)
    share = (1 - ANY_BYTE) * counts + ANY_BYTE / len(symbols) if letters.sum() else np.full(len(symbols), 1 / len(symbols))
    out = np.zeros(1 << GRAM_BITS)
    second, third = (x.ravel() for x in np.meshgrid(np.arange(len(symbols)), np.arange(len(symbols)), indexing="ij"))
    for first, symbol in enumerate(symbols):
        whole = ((symbol != 32) | (second != 0)) & ((second != 0) | (third != 0))
        y, z = second[whole], third[whole]
        gram = (np.uint32(symbol) << np.uint32(16)) | (symbols[y].astype(np.uint32) << np.uint32(8)) | symbols[z].astype(np.uint32)
        place = (gram * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
        out += np.bincount(place.astype(np.int64), share[first] * share[y] * share[z], minlength=len(out))
    return out / out.sum()


class Model:
    """``labels`` and the logarithm of each label's share of each gram; the last row of ``table`` is that of no label."""

    def __init__(self, labels: list[str], counts: np.ndarray, letters: np.ndarray):
        self.labels = labels
        background = _background(letters)
        self.table = np.zeros((len(labels) + 1, len(background)), np.float32)
        for i, n in enumerate(counts):
            self.table[i] = np.log((n + GRAM_SMOOTHING * len(background) * background) / (n.sum() + GRAM_SMOOTHING * len(background)))
        self.table[-1] = np.log(background)


def fit(labelled: DataFrame) -> Model:
    """From rows ``text, label``: counts per label and gram over all of them, and per byte.

    Each task adds up its own counts, so what is shuffled and what the driver
    takes is bounded by the number of labels, not of texts. Every label is kept,
    however rare; labels are languages, and the model holds 64 KB for each.
    """
    rows = labelled.where("label is not null and text is not null")
    labels = sorted(r.label for r in rows.select("label").distinct().collect())
    grams = 1 << GRAM_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        letters = np.zeros(256, np.int64)

        def rows_of(label: str | None, n: np.ndarray) -> pa.RecordBatch:
            held = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array([label] * len(held), pa.string()), pa.array(held, pa.int32()), pa.array(n[held], pa.int64())], ["label", "gram", "n"])

        for batch in batches:
            carried = column(batch, "label").to_pylist()
            for first, last, data, offsets in _chunks(batch):
                letters += np.bincount(np.where(_LETTER[data], _LOWER[data], np.uint8(32)), minlength=256)
                gram, text = _grams(data, offsets)
                here = sorted(set(carried[first:last]))
                number = {label: i for i, label in enumerate(here)}
                own = np.array([number[label] for label in carried[first:last]], np.int32)[text]
                gram = gram[np.argsort(own, kind="stable")]
                ends = np.cumsum(np.bincount(own, minlength=len(here)))
                for label, part in zip(here, np.split(gram, ends[:-1]), strict=True):
                    if label not in totals and len(totals) >= HELD_LABELS:
                        yield from (rows_of(*item) for item in totals.items())
                        totals = {}
                    totals[label] = totals.get(label, 0) + np.bincount(part, minlength=grams)
        yield from (rows_of(*item) for item in totals.items())
        yield rows_of(None, letters)

    table, letters = np.zeros((len(labels), grams), np.float32), np.zeros(256)
    if labels:
        counted = rows.select("text", "label").mapInArrow(giving_back(count), "label string, gram int, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))
        found = counted.toPandas()
        none = found["label"].isna().to_numpy()
        letters[found["gram"].to_numpy(np.int64)[none]] = found["n"].to_numpy()[none]
        place = {label: i for i, label in enumerate(labels)}
        table[[place[label] for label in found["label"][~none]], found["gram"].to_numpy(np.int64)[~none]] = found["n"].to_numpy()[~none]
    return Model(labels, table, letters)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """Replaces ``text`` by ``grams``, their number, and ``likelihoods``, the text's log-likelihood per label and, last, for none of them."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, likelihoods = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, len(model.table)))
            for first, last, data, offsets in _chunks(batch):
                gram, text = _grams(data, offsets)
                n = last - first
                grams[first:last] = np.bincount(text, minlength=n)
                for i, logs in enumerate(model.table):
                    likelihoods[first:last, i] = np.bincount(text, logs[gram], minlength=n)
            counted = np.minimum(grams, TEXT_GRAMS) / np.maximum(grams, 1)
            likelihoods *= (TEXT_WEIGHT * counted)[:, None]
            likelihoods[:, -1] += np.log(NONE_PRIOR)
            values = pa.array(likelihoods.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in kept), pa.array(grams), values], [*kept, "grams", "likelihoods"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(giving_back(run), f"{fields}, grams bigint, likelihoods array<double>")


def _normal(logs: Column) -> Column:
    """Probabilities from an array of logarithms."""
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, y: a + y))


def _sums(rows: DataFrame, key: list[str], labels: int, name: str) -> DataFrame:
    sums = F.array(*[F.sum(F.col("own")[i]) for i in range(labels)])
    return rows.groupBy(*key).agg(sums.alias(name))


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``language, posterior, accepted`` to rows that have ``text, declared, suffix, host, domain``.

    Evidence that is null is left out; a row without host has the prior of all
    rows. ``accepted`` is false where the text has no letters, or no language
    reaches ``LEAST_POSTERIOR`` against the others and none of them together.

    Defined cases: a null or empty text is not accepted, its language is the most
    probable one by the other evidence; a tie goes to the first label in
    alphabetical order; without any label the language is null and nothing is
    accepted; repeated rows count as often as they are there; further columns stay.
    """
    labels = len(model.labels) + 1  # the last one is none of them
    scored = written(score(rows, model), "scores")
    kept = [c for c in scored.columns if c not in ("grams", "likelihoods")]
    own = scored.withColumn("own", _normal(F.col("likelihoods")))
    everything = _sums(own, [], labels, "sums").first()["sums"]
    overall = np.asarray([x or 0.0 for x in everything]) + 1.0
    base = F.array(*[F.lit(float(x)) for x in overall / overall.sum()])
    weights = F.array(*[F.lit(float(x)) for x in overall])

    joined = own
    for key in ("declared", "suffix", "domain", "host"):
        found = _sums(own.where(F.col(key).isNotNull()), [key], labels, f"_{key}")
        joined = joined.join(found, key, "left")

    def level(sums: Column, parent: Column) -> Column:
        """Counts of a level without the row itself, smoothed towards the level above."""
        alone = F.zip_with(sums, F.col("own"), lambda n, x: F.greatest(n - x, F.lit(0.0)))
        size = F.aggregate(alone, F.lit(0.0), lambda a, y: a + y)
        smooth = F.zip_with(alone, parent, lambda n, p: (n + F.lit(PRIOR_ROWS) * p) / (size + PRIOR_ROWS))
        return F.when(sums.isNull(), parent).otherwise(smooth)

    def value(sums: Column) -> Column:
        """Logarithm of the share of a language's rows that carry the value (up to a factor common to all)."""
        smooth = F.zip_with(F.zip_with(sums, F.col("own"), lambda n, x: F.greatest(n - x, F.lit(0.0))), weights, lambda n, w: F.log((n + VALUE_ROWS * w / F.lit(float(overall.sum()))) / w))
        return F.when(sums.isNull(), F.transform(weights, lambda _: F.lit(0.0))).otherwise(smooth)

    def plus(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    prior = joined.withColumn("_over", level(F.col("_domain"), base)).withColumn("_prior", level(F.col("_host"), F.col("_over")))
    logs = plus(plus(F.col("likelihoods"), F.transform("_prior", lambda p: F.log(p))), plus(value(F.col("_declared")), value(F.col("_suffix"))))
    fused = prior.withColumn("_logs", logs).withColumn("_posteriors", F.slice(_normal(F.col("_logs")), 1, labels - 1))
    names = F.array(*[F.lit(label) for label in model.labels]) if model.labels else F.array().cast("array<string>")
    best = F.array_max("_posteriors")
    at = F.array_position("_posteriors", best)
    result = fused.select(
        *kept, "grams",
        F.when(at > 0, F.get(names, F.greatest(at - 1, F.lit(0)).cast("int"))).alias("language"),
        F.coalesce(best, F.lit(0.0)).alias("posterior"),
    )
    return result.withColumn("accepted", (F.col("grams") > 0) & (F.col("posterior") >= LEAST_POSTERIOR))


def page_evidence(pages: DataFrame) -> DataFrame:
    """``page_id, text, declared, suffix, host, domain`` of raw pages."""
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))
    markup = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?[a-z0-9]+;"
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce("html", F.lit("")), markup, " ").alias("text"),
        F.lower(F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1), F.lit(""))).alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
        host.alias("host"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, a hash of the text and the source as host; plain documents declare nothing."""
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("text_hash"), nothing.alias("declared"), nothing.alias("suffix"), F.col("source").alias("host"), nothing.alias("domain"),
    )
