"""Language of pages by Bayesian evidence fusion.

Four pieces of evidence are multiplied: the likelihood of the main text under each language, the likelihoods of the
declared markup language and of the language code in the address, and a prior from the page's host. All of it comes from
grouped aggregation: text likelihoods from documents with a known language, the others from the pages' own text
posteriors, summed by declaration, by address code, and by host, domain and suffix. A host's prior is smoothed by its
domain's, that by its suffix's, and that by the overall shares. A page's own posterior is taken out of its host's sums.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import bounded_batches, texts_of, unnested, without, written
from shoploom.llm.hosts import domain_of, host_of, path_of, suffix_of
from shoploom.llm.wrapper import main_text, parse

#: Hashed byte trigrams; a text counts as this many independent trigrams at most; smoothing in pages.
BUCKETS, EFFECTIVE, ADDED, PRIOR_PAGES = 1 << 15, 60.0, 0.5, 5.0
MOST_LANGUAGES = 200
POOLED = "other"

_DECLARED = re.compile(r"""<html\b[^>]*?\slang\s*=\s*["']?\s*([A-Za-z]{2,8})""", re.I)


def trigram_counts(text: bytes) -> np.ndarray:
    """Counts of the text's lower-cased byte trigrams by bucket, white space runs as one space."""
    codes = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(BUCKETS)
    mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
    return np.bincount(mixed >> np.uint32(17), minlength=BUCKETS)


def text_model(docs: DataFrame, text: str = "text", language: str = "lang", most: int = MOST_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-likelihood of each trigram bucket (rows) in each. Rows without text or language don't count.

    The `most` languages with the most text (of equals the first by name) stand for themselves, all others together for POOLED.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                counts = trigram_counts(value)
                sums[name] = sums[name] + counts if name in sums else counts
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at].astype(np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    bounded_batches(docs.sparkSession)
    known = docs.select(F.lower(F.trim(language)).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).where("lang != ''")
    sums = written(known.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    sizes = sums.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    own = [r["lang"] for r in sizes]
    if len(own) > most:
        own = own[:most]
        pooled = F.when(F.col("lang").isin(own), F.col("lang")).otherwise(POOLED)
        sums = sums.groupBy(pooled.alias("lang"), "bucket").agg(F.sum("n").alias("n"))
        own = [*own, POOLED]
    names = sorted(set(own))
    counts = np.full((BUCKETS, max(1, len(names))), 0.5)
    found = sums.toPandas()  # buckets times languages at most
    if len(found):
        counts[found["bucket"].to_numpy(), found["lang"].map({n: k for k, n in enumerate(names)}).to_numpy()] += found["n"].to_numpy()
    return names or ["und"], np.log(counts / counts.sum(axis=0))


def posterior(logs: np.ndarray, text: str) -> np.ndarray:
    """The languages' shares by the text alone. Trigrams overlap, so a long text's evidence is scaled down to EFFECTIVE of them."""
    counts = trigram_counts(text.encode())
    total = counts.sum()
    found = counts @ logs * min(1.0, EFFECTIVE / max(total, 1))
    found = np.exp(found - found.max())
    return found / found.sum()


def declared_language(page: str) -> str:
    found = _DECLARED.search(page)
    return found[1].lower() if found else ""


def address_code(url: Column) -> Column:
    """The first two-letter directory of the path, else the host's suffix."""
    parts = F.split(F.lower(path_of(url)), "/")
    directories = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.coalesce(F.get(F.filter(directories, lambda d: d.rlike("^[a-z]{2}$")), F.lit(0)), suffix_of(host_of(url)))


def _evidence(pages: DataFrame, logs: np.ndarray, url: str, markup: str) -> DataFrame:
    """row, host, code, declared, and the text's share of each language (p0, p1, ...)."""
    languages = logs.shape[1]
    address = F.col(f"`{url}`")
    rest = [F.col(f"`{c}`") for c in without(pages, [markup]).columns]
    thin = pages.select(F.struct(*rest).alias("row"), host_of(address).alias("host"), F.coalesce(address_code(address), F.lit("")).alias("code"), F.coalesce(F.col(f"`{markup}`"), F.lit("")).alias("html"))
    shares = [T.StructField(f"p{k}", T.DoubleType()) for k in range(languages)]
    schema = T.StructType([*thin.drop("html").schema.fields, T.StructField("declared", T.StringType()), *shares])

    def run(batches):
        for batch in batches:
            sources = [x.as_py() for x in batch.column(3)]
            found = np.array([posterior(logs, main_text(parse(s, shaped=False))) for s in sources]).reshape(-1, languages)
            columns = [pa.array([declared_language(s) for s in sources], pa.string()), *[pa.array(c.copy(), pa.float64()) for c in found.T]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=schema.names)

    return thin.mapInArrow(run, schema)


def _sums(df: DataFrame, key: str, names: list[str], prefix: str) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(n).alias(f"{prefix}{k}") for k, n in enumerate(names)])


def fused(pages: DataFrame, model: tuple[list[str], np.ndarray], url: str = "url", markup: str = "html") -> DataFrame:
    """`pages` without the markup, with lang, score (its posterior), text_lang, declared and address.

    Null markup or url are no evidence of that kind: such pages share the empty declaration, code and host. Of equally
    likely languages the first by name is given. Repeated pages are judged alike, an empty table gives an empty result,
    columns named like a result are replaced.
    """
    names, logs = model
    every = range(len(names))
    shares = [f"p{k}" for k in every]
    pages = written(_evidence(pages, logs, url, markup), "evidence")
    overall = pages.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(p), F.lit(0.0)).alias(p) for p in shares]).first()
    world = [(overall[p] + 1) / (overall["n"] + len(names)) for p in shares]

    def likelihood(key: str) -> DataFrame:
        """log P(value of `key` | language) for each value."""
        sums = written(_sums(pages, key, shares, f"{key}_"), key)
        values = sums.count()
        rates = [F.log((F.col(f"{key}_{k}") + ADDED) / (overall[p] + ADDED * (values + 1))).alias(f"{key}_{k}") for k, p in enumerate(shares)]
        return sums.select(key, *rates)

    # Host, domain and suffix: sums, and at each level the shares of the level above as PRIOR_PAGES more pages.
    hosts = _sums(pages, "host", shares, "h").withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(*[F.sum(f"h{k}").alias(f"d{k}") for k in every])
    suffixes = domains.groupBy("suffix").agg(*[F.sum(f"d{k}").alias(f"s{k}") for k in every])

    def smoothed(sums: str, above: list[Column]) -> list[Column]:
        total = reduce(Column.__add__, [F.col(f"{sums}{k}") for k in every]) + PRIOR_PAGES
        return [(F.col(f"{sums}{k}") + PRIOR_PAGES * above[k]) / total for k in every]

    by_suffix = smoothed("s", [F.lit(w) for w in world])
    by_domain = smoothed("d", by_suffix)
    priors = hosts.join(domains, ["domain", "suffix"]).join(suffixes, "suffix").select(
        "host", *[F.col(f"h{k}") for k in every], *[c.alias(f"up{k}") for k, c in enumerate(by_domain)]
    )
    both = pages.join(written(priors, "priors"), "host").join(likelihood("declared"), "declared").join(likelihood("code"), "code")
    others = [F.greatest(F.col(f"h{k}") - F.col(f"p{k}"), F.lit(0.0)) for k in every]
    logs_of = [
        F.log(F.col(f"p{k}") + 1e-12) + F.col(f"declared_{k}") + F.col(f"code_{k}") + F.log(others[k] + PRIOR_PAGES * F.col(f"up{k}")) for k in every
    ]
    both = both.select("*", *[c.alias(f"log{k}") for k, c in enumerate(logs_of)]).withColumn("top", F.greatest(*[f"log{k}" for k in every]) if len(names) > 1 else F.col("log0"))

    def first(prefix: str, top: Column) -> Column:
        return F.coalesce(*[F.when(F.col(f"{prefix}{k}") == top, F.lit(name)) for k, name in enumerate(names)])

    text_top = F.greatest(*shares) if len(names) > 1 else F.col("p0")
    score = 1 / reduce(Column.__add__, [F.exp(F.col(f"log{k}") - F.col("top")) for k in every])
    return unnested(
        both.select("row", first("log", F.col("top")).alias("lang"), score.alias("score"), first("p", text_top).alias("text_lang"), "declared", F.col("code").alias("address")),
        "lang", "score", "text_lang", "declared", "address",
    )
