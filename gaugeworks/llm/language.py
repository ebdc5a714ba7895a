"""Language of texts by fused evidence: text, declared language, address suffix and host.

A text's likelihood per language comes from hashed byte triples, fitted on a bounded
sample of labelled documents; as triples of one text depend on each other, it counts as
at most ``EVIDENCE`` of them. How far declarations and suffixes can be trusted is counted
over all rows: how often each is met with each language by text. Priors are smoothed
down a hierarchy, from all rows to a domain to a host, from grouped sums of the
likelihoods' posteriors, without the row itself. Bayes' rule joins the four. ``und``, a
language in which all triples are equally likely, stands for text in none of the others.

Defined results: null and empty texts count by their other evidence; a null or unknown
declaration or suffix is no evidence; null hosts or domains are one host or domain; equal rows get equal
results; a null id stays null; an empty table gives an empty table; without labelled
documents all is ``und``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shingles import mix
from gaugeworks.llm.tables import rows_of
from gaugeworks.session import settle

UNKNOWN = "und"
#: Labelled documents per language, those with the smallest hash.
SAMPLE = 1_000
BUCKETS = 8192
EVIDENCE = 150
#: Rows that a parent's shares weigh in a domain's or host's prior.
PARENT = 5.0

#: Letters and bytes of others as themselves, all else as one space.
_CODE = np.array([c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else c - 100 if c >= 128 else 0 for c in range(256)], np.uint64)


def triples(text: str) -> np.ndarray:
    """Numbers of the hashed byte triples of a text, those of spaces alone left out."""
    code = _CODE[np.frombuffer(text.encode("utf-8"), np.uint8)]
    joined = code[:-2] << np.uint64(16) | code[1:-1] << np.uint64(8) | code[2:]
    with np.errstate(over="ignore"):
        return np.bincount((mix(joined[joined > 0]) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]  # the last one is ``und``
    logs: np.ndarray  # language by bucket

    def likelihoods(self, text: str) -> np.ndarray:
        """Log likelihood per language, of at most ``EVIDENCE`` triples, the highest being 0."""
        count = triples(text)
        n = count.sum()
        logs = self.logs @ count * min(1.0, EVIDENCE / max(n, 1))
        return logs - logs.max()


def fit_text(labelled: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Triple frequencies per language from (text, lang), of every language. Sums of each language are made in Spark."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per language
    languages = sorted(r["lang"] for r in counts)
    # The bound of each language's hashes below which about ``sample`` of its documents lie.
    mark = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    share = {r["lang"]: min(1_000_000, 1_000_000 * sample // r["n"] + 1) for r in counts}
    limit = F.element_at(F.create_map(*(F.lit(x) for pair in share.items() for x in pair)), F.col("lang")) if share else F.lit(0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in rows_of(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                own = triples(text)
                sums[lang] = sums.get(lang, 0) + own / max(own.sum(), 1)
        names = ["lang", "bucket", "n"]
        for lang, own in sums.items():
            met = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(met), pa.string()), pa.array(met), pa.array(own[met].astype(float))], names=names)

    summed = rows.where(mark < limit).mapInArrow(count, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages) + 1, BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    sums = summed.toArrow()  # languages times buckets at most, in columns
    at = [place[lang] for lang in sums.column("lang").to_pylist()]
    table[np.array(at, np.int64), sums.column("bucket").to_numpy()] = np.round(sums.column("n").to_numpy(), 9)
    table[-1] = 1.0
    shares = table / np.maximum(table.sum(axis=1, keepdims=True), 1e-12)
    return TextModel((*languages, UNKNOWN), np.log(0.95 * shares + 0.05 / BUCKETS))


def _posterior(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _scored(df: DataFrame, model: TextModel) -> DataFrame:
    """Narrow rows: id, declared, suffix, domain, host, log likelihoods and their posterior."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            logs = np.array([model.likelihoods(t or "") for t in batch.column("text").to_pylist()])
            kept = [batch.column(c) for c in ("id", "declared", "suffix", "domain", "host")]
            lists = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in (logs, _posterior(logs))]
            yield pa.RecordBatch.from_arrays([*kept, *lists], names=["id", "declared", "suffix", "domain", "host", "logs", "p"])

    kind = dict(df.dtypes)["id"]
    return df.mapInArrow(score, f"id {kind}, declared string, suffix string, domain string, host string, logs array<double>, p array<double>")


def _sums(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"), *(F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)))


def _trust(scored: DataFrame, key: str, languages: tuple[str, ...]) -> tuple[list[str], np.ndarray]:
    """Values of ``key`` and the log chance of each given each language, smoothed towards agreement; the last, ``other``, says nothing."""
    n = len(languages)
    found = {r[key]: np.array([r[f"s{i}"] for i in range(n)]) for r in _sums(scored, key, n).collect()}  # a row per language at most
    values = list(languages[:-1])
    table = np.array([found.get(v, np.zeros(n)) for v in values]).reshape(len(values), n) + 0.5
    table[np.arange(n - 1), np.arange(n - 1)] += 2.0
    logs = np.log(table / table.sum(axis=0)) if values else table
    return [*values, "other"], np.concatenate([logs, np.zeros((1, n))])


def _known(value: Column, languages: tuple[str, ...]) -> Column:
    """The language that a tag like ``fr`` or ``fr-CA`` names, else ``other``."""
    tag = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]+)", 1)
    return F.when(tag.isin(*languages[:-1]), tag).otherwise("other") if len(languages) > 1 else F.lit("other")


def identify(df: DataFrame, model: TextModel) -> DataFrame:
    """(id, lang, p, text_lang) for rows (id, text, declared, suffix, domain, host).

    Rows meet the sums of their host and domain in joins without hints, which adaptive
    execution splits where a host has very many rows.
    """
    languages = model.languages
    n = len(languages)
    tagged = df.select(
        "id", "text", _known(F.col("declared"), languages).alias("declared"), _known(F.col("suffix"), languages).alias("suffix"),
        F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("host", F.lit("")).alias("host"),
    )
    scored = settle(_scored(tagged, model), "scored")
    declared, declared_logs = _trust(scored, "declared", languages)
    suffixes, suffix_logs = _trust(scored, "suffix", languages)
    whole = scored.agg(F.count("*").alias("n"), *(F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n))).first()
    top = (np.array([whole[f"s{i}"] or 0.0 for i in range(n)]) + 1.0 / n) / (whole["n"] + 1)

    def packed(key: str) -> DataFrame:
        return _sums(scored, key, n).select(key, F.col("n").cast("double").alias(f"{key}_n"), F.array(*(f"s{i}" for i in range(n))).alias(f"{key}_s"))

    domains_of = scored.select("host", "domain").groupBy("host").agg(F.min("domain").alias("domain"))
    hosts = settle(packed("host").join(domains_of, "host").join(packed("domain"), "domain").drop("domain"), "hosts")
    joined = scored.join(hosts, "host")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 8192):
            logs, own, host, domain = (np.array(batch.column(c).flatten()).reshape(-1, n) for c in ("logs", "p", "host_s", "domain_s"))
            host_n, domain_n = (batch.column(c).to_numpy()[:, None] for c in ("host_n", "domain_n"))
            prior = (np.maximum(domain - own, 0) + PARENT * top) / (domain_n - 1 + PARENT)
            prior = (np.maximum(host - own, 0) + PARENT * prior) / (host_n - 1 + PARENT)
            said = declared_logs[[declared.index(v) for v in batch.column("declared").to_pylist()]]
            ends = suffix_logs[[suffixes.index(v) for v in batch.column("suffix").to_pylist()]]
            p = _posterior(logs + np.log(np.maximum(prior, 1e-9)) + said + ends)
            best, by_text = p.argmax(axis=1), logs.argmax(axis=1)
            columns = [
                batch.column("id"), pa.array([languages[i] for i in best]), pa.array(p[np.arange(len(p)), best]), pa.array([languages[i] for i in by_text]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "p", "text_lang"])

    return joined.mapInArrow(fuse, f"id {dict(df.dtypes)['id']}, lang string, p double, text_lang string")


def page_evidence(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Rows for :func:`identify` from web pages: text without markup, the declared language, address suffix, domain and host."""
    html, url = F.col(html_column), F.lower(F.col(url_column))
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[a-zA-Z]+;|&#\d+;", " ")
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/:?#]+)", 1)
    # A language as the first part of the path, else the last label of the host.
    path = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[-_][a-z]{2})?(?:[/?#]|$)", 1)
    last = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    return pages.select(
        F.col(id_column).alias("id"),
        text.alias("text"),
        F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z-]+)", 1).alias("declared"),
        F.when(path != "", path).otherwise(last).alias("suffix"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        host.alias("host"),
    )
