"""Language identification by Bayesian fusion of evidence.

The text gives a likelihood under a model per language: counts of byte four-grams, hashed into ``GRAMS`` buckets and gathered
over all labelled texts. To it come the declared markup language, the suffix of the address, and a prior of the host. What
these say is learned from the rows themselves, by grouped sums of the texts' own posteriors: how often a declared value or a
suffix goes with a language, and which languages a host, its domain and all hosts have. A host's prior is smoothed towards
its domain's and that towards the overall one, and leaves out the row that it is applied to.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..sources.workspace import store
from . import sums
from .arrow import as_bytes, slices
from .columns import neutral
from .words import buffer_of

#: Where no labelled row names a language.
LANGUAGES = ("de", "en", "es", "fr")
#: A language is learned if this share of the labelled rows has it; so there are 100 at most.
LEAST_SHARE = 0.01
#: Codes that name no language: several, uncoded, undetermined, no linguistic content.
NO_LANGUAGE = ("mul", "mis", "und", "zxx")
GRAM_BITS = 16
GRAMS = 1 << GRAM_BITS
#: Four-grams overlap: each counts as a quarter of an independent observation.
POWER = 0.25
#: Share of evenly spread four-grams in every language: names, code, noise.
UNKNOWN = 0.1
#: Rows that a host's prior is worth before it has rows of its own, and the least posterior to accept.
HOST_WEIGHT, DOMAIN_WEIGHT, LEAST = 5.0, 20.0, 0.5
CHUNK = 1 << 19
PARTS = 16

_CLEAN = np.full(256, 32, dtype=np.uint8)
_CLEAN[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]
_CLEAN[65:91] = np.arange(97, 123)


# ---- text --------------------------------------------------------------------------------------------------------


def visible(page: bytes | None) -> bytes:
    """Text of a page without tags, scripts and styles, in one pass."""
    if page is None:
        return b""
    first, *rest = page.split(b"<")
    out, skip = [first], b""
    for part in rest:
        tag, close, text = part.partition(b">")
        name = tag[:8].lower()
        if skip:
            if not name.startswith(skip):
                continue
            skip = b""
        elif name.startswith((b"script", b"style")):
            skip = b"/" + name[:5]
            continue
        if close:
            out.append(text)
    joined = b" ".join(out)
    return html.unescape(joined.decode("utf-8", "replace")).encode() if b"&" in joined else joined


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each four-gram that has a letter, the number of its text, and how many letters each text has. Runs of
    other characters, and both ends of a text, are one space."""
    data, at = buffer_of(column)
    clean = np.append(np.uint8(32), _CLEAN[data])
    text = np.append(0, np.repeat(np.arange(len(at) - 1), np.diff(at)))
    letters = np.bincount(text[clean != 32], minlength=len(at) - 1)
    keep = np.ones(len(clean), dtype=bool)
    keep[1:] = (clean[1:] != 32) | (clean[:-1] != 32)
    clean, text = clean[keep].astype(np.uint32), text[keep]
    if len(clean) < 4:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), letters
    four = (clean[:-3] << 24) | (clean[1:-2] << 16) | (clean[2:-1] << 8) | clean[3:]
    whole = (text[1:-2] == text[3:]) & ((text[:-3] == text[3:]) | (clean[:-3] == 32))
    bucket = (four * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    return bucket[whole].astype(np.int64), text[3:][whole], letters


def languages_of(labelled: DataFrame, least_share: float = LEAST_SHARE) -> tuple[str, ...]:
    """The languages that at least a share of the labelled rows declares, ``LANGUAGES`` if there is none."""
    given = labelled.select(_primary(F.col("lang")).alias("language")).where((F.col("language") != "") & ~F.col("language").isin(*NO_LANGUAGE))
    least = least_share * given.count()
    # 1 / least_share rows at most
    found = given.groupBy("language").count().where(F.col("count") >= least).select("language").collect()
    return tuple(sorted(r[0] for r in found)) or LANGUAGES


def text_model(labelled: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Logarithm of each four-gram's probability in each language, from all rows of ``labelled`` (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), GRAMS), dtype=np.int64)
        for batch in slices(batches, "text", CHUNK):
            bucket, text, _ = grams(batch.column("text"))
            own = batch.column("language").to_numpy(zero_copy_only=False)[text]
            total += np.bincount(own * GRAMS + bucket, minlength=total.size).reshape(total.shape)
        if total.any():
            for part, values in enumerate(np.split(total, PARTS, axis=1)):
                yield sums.part(part, values)

    number = F.array_position(F.array(*map(F.lit, languages)), _primary(F.col("lang"))) - 1
    known = labelled.select(F.col("text").cast("string").alias("text"), number.cast("int").alias("language")).where("language >= 0 and text is not null")
    total = np.zeros((len(languages), GRAMS), dtype=np.float64)
    width = GRAMS // PARTS
    # a fixed number of counts in all: languages x GRAMS
    for part, data in sums.added(known.mapInArrow(count, sums.KIND), np.int64).collect():
        total[:, part * width : (part + 1) * width] = np.frombuffer(data, dtype=np.int64).reshape(len(languages), width)
    share = (total + 0.5) / (total.sum(axis=1, keepdims=True) + 0.5 * GRAMS)
    return np.log((1 - UNKNOWN) * share + UNKNOWN / GRAMS)


def _primary(value: Column) -> Column:
    """``en`` of ``EN-us``."""
    return F.lower(F.regexp_extract(value, r"^\s*([A-Za-z]+)", 1))


def text_scores(rows: DataFrame, model: np.ndarray, keep_text: bool, markup: bool = False) -> DataFrame:
    """``rows`` with ``_text`` (tempered log-likelihood of each language), ``_grams`` and ``_letters``; with or
    without ``text``."""
    kept = [f for f in rows.schema.fields if keep_text or f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            column = batch.column("text")
            bucket, text, letters = grams(pa.array([visible(t) for t in as_bytes(column)], pa.large_binary()) if markup else column)
            n = np.bincount(text, minlength=batch.num_rows)
            score = np.stack([np.bincount(text, weights=m[bucket], minlength=batch.num_rows) for m in model], axis=1)
            columns = [batch.column(f.name) for f in kept] + [pa.array(list(POWER * score), pa.list_(pa.float64())), pa.array(n), pa.array(letters)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["_text", "_grams", "_letters"])

    made = [StructField("_text", ArrayType(DoubleType())), StructField("_grams", LongType()), StructField("_letters", LongType())]
    return rows.mapInArrow(run, StructType([*kept, *made]))


# ---- evidence ----------------------------------------------------------------------------------------------------


def _softmax(log: Column) -> Column:
    exp = F.transform(log, lambda x: F.exp(x - F.array_max(log)))
    return F.transform(exp, lambda x: x / F.aggregate(exp, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, by: str, size: int) -> DataFrame:
    """Sum of the texts' posteriors for each value of a column."""
    total = F.array(*[F.sum(F.col("_own")[i]) for i in range(size)])
    by_value = df.where(F.col(by).isNotNull()).groupBy(by).agg(total.alias(f"_{by}_n"))
    # stored, so that Spark knows its size before it plans the join: texts are not shuffled for a small table
    return store(by_value, f"{by}-evidence")


def identify(rows: DataFrame, scores: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """``rows`` (with the text scores, and ``declared``, ``suffix``, ``domain`` and ``host``, each of which may be null or
    left out) with ``language``, ``probability`` and ``accepted``. ``scores`` are the stored rows of which the evidence is learned.

    A row is accepted if its text has a letter, if its best language is at least as likely as ``LEAST``, and unless nearly all
    its four-grams are unknown in that language. Without four-grams the other evidence decides.
    """
    size = len(languages)
    known = scores.where("_grams > 0").withColumn("_own", _softmax(F.col("_text")))
    overall = known.agg(*[F.sum(F.col("_own")[i]) for i in range(size)]).first()
    total = sum(x or 0.0 for x in overall) + size
    prior = [((x or 0.0) + 1) / total for x in overall]
    out = rows.withColumn("_own", F.when(F.col("_grams") > 0, _softmax(F.col("_text"))).otherwise(F.array(*[F.lit(0.0)] * size)))
    log = F.col("_text")
    there = [c for c in ("declared", "suffix", "domain", "host") if c in rows.columns]
    for by in [c for c in ("declared", "suffix") if c in there]:
        values = _sums(known, by, size)
        out = out.join(values, by, "left")
        # P(value | language) up to a factor: the value's sums over the language's, one row of its own language added
        own = [F.greatest(F.col(f"_{by}_n")[i] - F.col("_own")[i], F.lit(0.0)) for i in range(size)]
        agrees = [F.lit(1.0) if by == "suffix" else F.when(_primary(F.col(by)) == x, 2.0).otherwise(0.5) for x in languages]
        said = F.array(*[F.log((o + a) / F.lit(prior[i] * total)) for i, (o, a) in enumerate(zip(own, agrees))])
        log = F.zip_with(log, F.when(F.col(f"_{by}_n").isNotNull(), said).otherwise(F.array(*[F.lit(0.0)] * size)), lambda a, b: a + b)
    for by in [c for c in ("domain", "host") if c in there]:
        out = out.join(_sums(known, by, size), by, "left")
    zero = F.lit(0.0)
    others = lambda by, i: F.greatest(F.coalesce(F.col(f"_{by}_n")[i] - F.col("_own")[i], zero), zero) if by in there else zero
    domain = [others("domain", i) + DOMAIN_WEIGHT * prior[i] for i in range(size)]
    host = [others("host", i) for i in range(size)]
    # a column, as every language's term has it
    out = out.withColumn("_domain_sum", sum(domain[1:], domain[0]))
    domain_sum = F.col("_domain_sum")
    host_sum = sum(host[1:], host[0]) + HOST_WEIGHT
    place = F.array(*[F.log((h + HOST_WEIGHT * d / domain_sum) / host_sum) for h, d in zip(host, domain)])
    out = out.withColumn("_log", F.zip_with(log, place, lambda a, b: a + b)).withColumn("_p", _softmax(F.col("_log")))
    best = F.array_position(F.col("_p"), F.array_max("_p"))
    likely = (F.col("_grams") == 0) | (F.array_max("_text") > POWER * F.col("_grams") * float(np.log(UNKNOWN / GRAMS) + 0.25))
    return out.withColumns(
        {
            "language": F.element_at(F.array(*map(F.lit, languages)), best.cast("int")),
            "probability": F.array_max("_p"),
            "accepted": (F.col("_letters") > 0) & (F.array_max("_p") >= LEAST) & likely,
        }
    ).drop("_own", "_log", "_p", "_declared_n", "_suffix_n", "_domain_n", "_host_n", "_domain_sum")


def identify_pages(pages: DataFrame, labelled: DataFrame, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Language of each page: page_id, language, probability, accepted, declared, suffix, host. ``languages`` are those of the
    labelled rows, if not given.

    Null or empty html has no text evidence and is not accepted, a null or odd address gives no evidence, repeated pages count
    each. An empty table gives no rows.
    """
    languages = languages or languages_of(labelled)
    url = F.lower(F.col("url"))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    none = lambda c: F.when(c != "", c)
    rows = pages.select(
        "page_id",
        none(_primary(F.regexp_extract("html", r"""(?i)<html\b[^>]*\blang\s*=\s*["']?\s*([a-z]+)""", 1))).alias("declared"),
        none(F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"),
        none(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"),
        none(host).alias("host"),
        F.col("html").cast("string").alias("text"),
    )
    scores = store(text_scores(rows, text_model(labelled, languages), keep_text=False, markup=True), "page-scores")
    return identify(scores, scores, languages).select("page_id", "language", "probability", "accepted", "declared", "suffix", "host")


def keep_identified(docs: DataFrame, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of ``docs`` (text, lang as declared, source as host) whose language is accepted, with its columns. ``languages``
    are those that the rows declare, if not given.

    Null and empty texts, and texts without a letter, are rejected; very long ones are scored whole. A null ``lang`` declares
    nothing, a null ``source`` has no prior of its own. Repeated rows stay or go each. An empty table gives no rows. Other columns
    may have any name.
    """
    languages = languages or languages_of(docs)
    plain, back = neutral(docs, "text")
    lang, source = (plain.columns[docs.columns.index(c)] for c in ("lang", "source"))
    rows = plain.withColumns({"declared": _primary(F.col(lang)), "host": F.col(source).cast("string")})
    model = text_model(docs.select("text", "lang"), languages)
    narrow = rows.select("text", "declared", "host")
    scores = store(text_scores(narrow, model, keep_text=False), "document-scores")
    return back(identify(text_scores(rows, model, keep_text=True), scores, languages).where("accepted"))
