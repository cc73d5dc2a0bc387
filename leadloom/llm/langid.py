"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior over the languages of a labelled text table:

* the page's text: hashed character trigrams under a naive Bayes model, tempered because neighbouring trigrams repeat
  each other;
* the language that the markup declares, and the suffix of the address: P(value | language), counted over all pages with
  the language that their text suggests, and smoothed;
* the host: a prior smoothed level by level, the host's counts towards its registrable domain's (``firm.co.uk``, not ``co.uk``),
  these towards the whole corpus's;
  a page's own count is left out.

Scale: the trigram model is fitted on a bounded sample of labelled texts of each language (``train_rows`` in all);
the languages are counted over all of them. Pages are read once and
reduced to some numbers each; all counts are grouped aggregations over all pages. Hosts join by their key: broadcast if
they are counted as few, by shuffle otherwise.

Edge cases: pages without text, host or declaration have no such evidence (probability alike for all languages); ties go
to the first language by code; repeated rows are counted and judged each; an empty page table gives an empty result;
without labelled texts there is no language and the result's languages are null; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import root_domain
from leadloom.llm.hashing import mix
from leadloom.llm.shared import small_keys, written

DIMENSIONS = 4096
TRAIN_ROWS = 10_000
#: Texts of a language that are sampled, if there are so many, even where languages are very many.
LEAST_TRAIN_ROWS = 100
#: Trigrams that count as one independent observation, and the most observations of a text.
TEMPER, MOST = 8.0, 60.0
#: Pseudo-counts: of trigrams, of declarations and suffixes, of a level's prior.
GRAM_SMOOTHING, VALUE_SMOOTHING, LEVEL_WEIGHT = 0.5, 1.0, 5.0

_DROPPED = re.compile(r"(?is)<(script|style|nav|header|footer|aside|template|noscript)\b.*?</\1\s*>|<!--.*?-->")
_ADS = re.compile(r"""(?is)<div[^>]*class=["'][^"']*\b(?:ad|ads|advert|sidebar|menu)\b[^>]*>.*?</div\s*>""")
_TAG = re.compile(r"(?s)<[^>]*>")
_DECLARED = re.compile(r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""")
_U = np.uint64


def page_text(markup: str) -> str:
    """The text of a page without navigation, advertisements, scripts and tags."""
    markup = _ADS.sub(" ", _DROPPED.sub(" ", markup))
    at = markup.lower().find("<body")
    return html.unescape(_TAG.sub(" ", markup[max(0, at):]))


def gram_counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed character trigrams of the lower-cased letters; other characters count as one space."""
    codes = np.frombuffer(" ".join(re.findall(r"[^\W\d_]+", text.lower())).encode("utf-32-le"), dtype=np.uint32).astype(_U)
    codes = np.concatenate(([_U(32)], codes, [_U(32)]))
    if len(codes) < 3:
        return np.zeros(dimensions)
    grams = mix((codes[:-2] << _U(42)) ^ (codes[1:-1] << _U(21)) ^ codes[2:])
    return np.bincount((grams % _U(dimensions)).astype(np.int64), minlength=dimensions).astype(np.float64)


def fit_text_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Language codes, ascending, and log P(trigram | language), from a sample of about ``train_rows`` labelled texts, alike
    for each language: one with fewer texts gives them all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums[lang] = sums.get(lang, 0) + gram_counts(text)
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(counts[at])], names=["lang", "gram", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.lower(F.col(lang_col).cast("string")).alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    million = 1_000_000
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)  # all labelled rows name the classes, however few they are
    each = max(LEAST_TRAIN_ROWS, -(-train_rows // max(1, len(langs))))
    shares = [F.lit(x) for k in langs for x in (k, min(million, -(-each * million // sizes[k])))]
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(million)) < F.create_map(*shares)[F.col("lang")]) if langs else rows.limit(0)
    got = sample.mapInArrow(count, "lang string, gram long, n double").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # at most DIMENSIONS rows for each language
    table = np.full((len(langs), DIMENSIONS), GRAM_SMOOTHING)
    if langs:
        table[np.searchsorted(langs, got.column("lang").to_pylist()), got.column("gram").to_numpy()] += got.column("n").to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def read_pages(pages: DataFrame, langs: list[str], model: np.ndarray, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, domain, suffix, declared, text: tempered log-likelihoods by language, guess: the likeliest number)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, scores = [], []
            for markup in batch.column("html").to_pylist():
                m = _DECLARED.search(markup or "")
                declared.append(m[1].lower()[:3] if m else "")
                counts = gram_counts(page_text(markup or ""))
                n = counts.sum()
                logs = model @ counts * (min(n / TEMPER, MOST) / n) if n else np.zeros(len(langs))
                scores.append((logs - logs.max()).tolist() if len(langs) else [])
            guess = [int(np.argmax(s)) if s and min(s) < 0 else -1 for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), pa.array(declared), pa.array(scores, pa.list_(pa.float64())), pa.array(guess, pa.int32())],
                                             names=["id", "host", "declared", "text", "guess"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    source = pages.select(F.col(id_col).alias("id"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()
    read_rows = source.mapInArrow(read, f"id {kind}, host string, declared string, text array<double>, guess int")
    return read_rows.withColumns({"domain": root_domain(F.col("host")), "suffix": F.substring_index("host", ".", -1)})


def _counts(rows: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """For each key the number of guesses of each language, as an array."""
    each = [F.sum((F.col("guess") == k).cast("long")).cast("double") for k in range(size)]
    return rows.groupBy(*by).agg(F.array(*each).alias(name))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def identify(pages: DataFrame, langs: list[str], model: np.ndarray, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, declared, suffix, text_lang, lang, probability, evidence) of every page.

    ``evidence`` holds the log terms by kind, each an array by language in the order of ``langs``.
    """
    k = len(langs)
    kind = pages.schema[id_col].dataType.simpleString()
    if not k:
        return pages.select(F.col(id_col), *[F.lit(None).cast("string").alias(c) for c in ("host", "declared", "suffix", "text_lang", "lang")], F.lit(None).cast("double").alias("probability"))
    rows = written(read_pages(pages, langs, model, id_col=id_col, url_col=url_col, html_col=html_col), "pages")
    rows = rows.select(F.col("id").cast(kind).alias("id"), "host", "domain", "suffix", "declared", "text", "guess")
    hosts = written(_counts(rows, ["suffix", "domain", "host"], k, "host_n"), "hosts")
    sums = lambda c: F.array(*[F.sum(F.col(c)[i]) for i in range(k)])
    domains = hosts.groupBy("domain").agg(sums("host_n").alias("domain_n"))
    suffixes = hosts.groupBy("suffix").agg(sums("host_n").alias("suffix_n"))
    whole = hosts.agg(sums("host_n").alias("n")).first()["n"] or [0.0] * k
    declared = _counts(rows, ["declared"], k, "declared_n")
    n_declared, n_suffixes = declared.count(), suffixes.count()
    joined = rows.join(small_keys(declared), "declared").join(small_keys(suffixes), "suffix")
    joined = joined.join(small_keys(hosts.join(domains, "domain").select("host", "host_n", "domain_n")), "host")

    every = F.array(*[F.lit(float(x or 0)) for x in whole])
    own = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == F.col("guess")).cast("double"))
    less = lambda a: F.zip_with(a, own, lambda x, o: F.greatest(x - o, F.lit(0.0)))  # noqa: E731  without the page itself
    value = lambda c, kinds: F.zip_with(less(F.col(c)), less(every), lambda x, n: F.log((x + VALUE_SMOOTHING / kinds) / (n + VALUE_SMOOTHING)))

    def level(counts: Column, above: Column) -> Column:
        return F.zip_with(counts, above, lambda x, p: (x + LEVEL_WEIGHT * p) / (_total(counts) + LEVEL_WEIGHT))

    joined = joined.withColumns({
        "text_e": F.col("text"),
        "declared_e": F.when(F.col("declared") == "", F.array_repeat(F.lit(0.0), k)).otherwise(value("declared_n", max(1, n_declared))),
        "suffix_e": F.when(F.col("suffix") == "", F.array_repeat(F.lit(0.0), k)).otherwise(value("suffix_n", max(1, n_suffixes))),
        "h": less(F.col("host_n")), "d": less(F.col("domain_n")), "w": less(every),
    })
    joined = joined.withColumn("w", level(F.col("w"), F.array_repeat(F.lit(1.0 / k), k)))
    joined = joined.withColumn("d", level(F.col("d"), F.col("w")))
    joined = joined.withColumn("host_e", F.transform(level(F.col("h"), F.col("d")), lambda p: F.log(p)))
    fused = joined.withColumn("logs", F.array(*[F.round(sum((F.col(c)[i] for c in ("declared_e", "suffix_e", "host_e")), F.col("text_e")[i]), 9) for i in range(k)]))
    best = F.array_max("logs")
    names = F.array(*[F.lit(x) for x in langs])
    return fused.select(
        F.col("id").alias(id_col), "host", "declared", "suffix",
        F.when(F.col("guess") >= 0, F.get(names, F.col("guess"))).alias("text_lang"),
        F.get(names, (F.array_position("logs", best) - 1).cast("int")).alias("lang"),
        F.round(1 / F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - best)), 6).alias("probability"),
        F.struct(F.col("text_e").alias("text"), F.col("declared_e").alias("declared"), F.col("suffix_e").alias("suffix"), F.col("host_e").alias("host")).alias("evidence"),
    )
