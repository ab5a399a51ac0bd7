"""Language identification by Bayesian fusion of evidence.

For each page and language: likelihood of the visible text (hashed character trigrams, tempered, as neighbours depend on each
other), of the language declared in the markup, and of the address (suffix, subdomain and path), times a prior of the host,
smoothed towards that of its domain and the whole. How far a declaration or address can be trusted is estimated from the
pages themselves: counts of (declared, language by text) give a smoothed table per kind of evidence. Priors are grouped sums
of the text posteriors over hosts and domains, less the page's own share, so that no page confirms itself.

Trigram tables are fitted on at most ``fit_rows`` texts of known language, those of least hashed doc_id. Null or empty html
leaves the other evidence; without any, the prior decides; ties go to the language first in the alphabet. A null or odd
address has the host ''. Without texts of known language there is no language to choose and the result's is null. Repeated
rows repeat; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import quiet_threads, slices, stage
from foliary.llm.tag_paths import main_text

BUCKETS = 1 << 15
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})|http-equiv\s*=\s*[\"']?content-language[\"']?\s+content\s*=\s*[\"']?([a-zA-Z]{2,3})", re.I)
RESULT = "page_id long, url string, host string, declared string, language string, probability double"


def trigrams(text: str) -> np.ndarray:
    """Bucket of each character trigram of the lower-case text, letters and spaces alone."""
    points = np.frombuffer(re.sub(r"[\W\d_]+", " ", f" {text} ".lower()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    h = (points[:-2] * np.uint64(1_000_003) + points[1:-1]) * np.uint64(1_000_003) + points[2:]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)


def train(docs: DataFrame, fit_rows: int = 4000) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and the log-probability of each bucket in each."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    ids = stage(rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "fit-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
            for lang, x in sums.items():
                at = np.flatnonzero(x)
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(x[at])], names=["lang", "bucket", "n"])

    found = rows.join(F.broadcast(ids), "doc_id").select("text", "lang").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    table = np.full((len(languages), BUCKETS), 0.05)
    for i, lang in enumerate(languages):
        own = found[found["lang"] == lang]
        table[i, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return languages, np.log(table / table.sum(1, keepdims=True))


def address(url: str | None, languages: list[str]) -> tuple[str, str, str]:
    """(host, domain, language the address names or '')."""
    m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)(?::\d+)?([^?#]*)", url or "")
    if not m:
        return "", "", ""
    host = m.group(1).lower()
    labels = host.split(".")
    named = [labels[-1], labels[0], *(p.lower()[:2] for p in m.group(2).split("/")[1:3] if re.fullmatch(r"[a-zA-Z]{2}(?:[-_][a-zA-Z]{2})?", p))]
    known = set(languages)
    return host, ".".join(labels[-2:]), next((x for x in reversed(named) if x in known), "")


def _soft(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _trust(counts: dict[tuple[str, str], float], languages: list[str], smoothing: float = 2.0) -> dict[str, np.ndarray]:
    """log P(evidence | language) for each value of the evidence."""
    values = sorted({v for v, _ in counts})
    table = np.array([[counts.get((v, x), 0.0) for x in languages] for v in values]).reshape(len(values), len(languages)) + smoothing / max(1, len(values))
    table = np.log(table / table.sum(0, keepdims=True))
    return dict(zip(values, table, strict=True))


def identify(pages: DataFrame, docs: DataFrame, fit_rows: int = 4000, temper: float = 0.1, kappa: float = 5.0) -> DataFrame:
    languages, table = train(docs, fit_rows)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    if not languages:
        return rows.select("page_id", "url", F.lit("").alias("host"), F.lit("").alias("declared"), F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"))
    n = len(languages)
    schema = "page_id long, url string, host string, domain string, declared string, named string, margins array<double>, posterior array<double>, best string"
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("html"), 8_000_000):
                part = batch.slice(start, stop - start)
                found: list[tuple] = []
                margins = np.zeros((part.num_rows, n))
                for i, (url, html) in enumerate(zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True)):
                    own = trigrams(main_text(html))
                    margins[i] = temper * table[:, own].sum(1) if len(own) else 0
                    m = _LANG.search(html or "")
                    declared = ((m.group(1) or m.group(2)) if m else "").lower()
                    found.append((*address(url, languages), declared))
                soft = _soft(margins)
                hosts, domains, named, declared_all = (pa.array([x[i] for x in found], pa.string()) for i in range(4))
                best = pa.array([languages[i] for i in soft.argmax(1)], pa.string())
                lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (margins, soft)]
                yield pa.record_batch([part.column("page_id"), part.column("url"), hosts, domains, declared_all, named, *lists, best], names=names)

    evidence = stage(rows.mapInArrow(read, schema), "evidence")
    counted = lambda c: {(r[c], r["best"]): float(r["n"]) for r in evidence.groupBy(c, "best").agg(F.count("*").alias("n")).collect()}
    # as many rows as languages and declared codes of two or three letters: bounded whatever the pages
    of_declared, of_named = _trust(counted("declared"), languages), _trust(counted("named"), languages)
    parts = [F.sum(F.col("posterior")[i]) for i in range(n)]
    sums = lambda key: evidence.groupBy(key).agg(F.array(*parts).alias(f"{key}_sum"))
    whole = np.array(evidence.agg(F.array(*parts).alias("x")).first()["x"] or [0.0] * n, dtype=float)
    hosts = evidence.groupBy("host", "domain").agg(F.array(*parts).alias("host_sum")).join(sums("domain"), "domain").drop("domain")
    joined = evidence.drop("best", "domain").join(hosts, "host")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for b in batches:
            if not b.num_rows:
                continue
            margins, own, host, domain = (np.array(b.column(c).to_pylist(), float).reshape(-1, n) for c in ("margins", "posterior", "host_sum", "domain_sum"))
            share = lambda x: np.maximum(x, 0)
            top = (whole + 1) / (whole.sum() + n)
            middle = share(domain - own) + kappa * top
            middle /= middle.sum(1, keepdims=True)
            prior = share(host - own) + kappa * middle
            prior /= prior.sum(1, keepdims=True)
            flat = np.zeros(n)
            said = np.array([of_declared.get(x, flat) for x in b.column("declared").to_pylist()]) + np.array([of_named.get(x, flat) for x in b.column("named").to_pylist()])
            soft = _soft(margins + said + np.log(prior))
            best = soft.argmax(1)
            yield pa.record_batch([*(b.column(c) for c in ("page_id", "url", "host", "declared")), pa.array([languages[i] for i in best], pa.string()), pa.array(soft[np.arange(len(best)), best])], names=[x.split()[0] for x in RESULT.split(", ")])

    return joined.mapInArrow(fuse, RESULT)
