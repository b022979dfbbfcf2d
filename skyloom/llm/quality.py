"""Quality by hierarchical empirical Bayes.

1. Evidence. A logistic model of a text's shape (SHAPE) gives each document a probability of good quality. It is fitted
   on at most `rows` labelled rows that are not held out, the first by a hash of doc_id; only their shapes, one for each
   doc_id, reach the driver.
2. Sites. Hosts, and paths within hosts, get posterior rates from grouped sums of that evidence. Each level is shrunk
   toward the one above: rate = (strength * rate above + sum) / (strength + n). A level's strength is the moment estimate
   of the beta prior from the spread of its groups' means; a site with few documents stays near its host, a sparse host
   near the global rate.
3. A document's posterior adds to its own log-odds those of its path's rate, without the document itself, over the
   global rate.

All sums are over all documents. Groups are summed before the shuffle, so that a host with a third of all documents
costs a row a task; host and path rates are joined back to (doc_id, host, path, evidence), not to texts.

Defined results: null and empty texts have shape zero. A null host or path is a site of its own. Repeated rows count as
often as they occur. Without labelled rows of both classes the evidence is one half. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from skyloom.llm.common import cut, table
from skyloom.llm.toxicity import held_out, labelled

ROWS = 6000
KEEP = 0.5
SHAPE = ("log words", "word length", "distinct words", "commonest word", "repeated lines", "letters", "digits", "upper case", "punctuation", "marks", "sentence length", "log lines", "repeated pairs")


def shape(text: str | None) -> list[float]:
    t = text or ""
    words = t.split()
    if not words:
        return [0.0] * len(SHAPE)
    n, size = len(words), len(t)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in t.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, t))
    digits, upper = sum(map(str.isdigit, t)), sum(map(str.isupper, t))
    stops = t.count(".") + t.count("!") + t.count("?")
    commas = t.count(",") + t.count(";") + t.count(":")
    white = sum(map(str.isspace, t))
    return [
        np.log1p(n), (size - white) / n, len(counts) / n, max(counts.values()) / n, 1 - len(set(lines)) / max(1, len(lines)), letters / size, digits / size,
        upper / max(1, letters), (stops + commas) / n, (size - letters - digits - white - stops - commas) / n, n / (stops + 1), np.log1p(len(lines)), 1 - len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
    ]


class Logistic:
    """Ridge logistic regression on standardised columns, their squares and pairwise products, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25):
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = self.widen(x)
        self.w = np.zeros(z.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            g = z.T @ (p - y) + ridge * self.w
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(self.w))
            step = np.linalg.solve(h, g)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break

    def widen(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        i, j = np.triu_indices(z.shape[1])
        return np.concatenate([np.ones((len(z), 1)), z, z[:, i] * z[:, j]], 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.widen(x) @ self.w, -12, 12)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> Logistic | None:
    own = labels.filter(~held_out("doc_id") & F.col(label).isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col(label).alias("__y")).dropDuplicates(["__id"])
    chosen = own.orderBy(F.xxhash64(F.lit(17), "__id"), "__id").limit(rows)
    got = labelled(docs, chosen, shape, ArrayType(DoubleType()))
    if len({r["__y"] for r in got}) < 2:
        return None
    return Logistic(np.array([r["x"] for r in got]), np.array([float(r["__y"]) for r in got]))


def evidence(docs: DataFrame, model: Logistic | None) -> DataFrame:
    """doc_id, host, path, p of docs(doc_id, text, host, path)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            p = np.full(len(texts), 0.5) if model is None or not texts else model(np.array([shape(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), batch.column(3), pa.array(p, pa.float64())], names=["doc_id", "host", "path", "p"])

    return docs.select("doc_id", "text", "host", "path").mapInArrow(run, "doc_id long, host string, path string, p double")


def strength(sites: DataFrame) -> float:
    """Moment estimate of a beta prior's weight from rates of sites(n, s, above): how far they spread beyond chance."""
    r = sites.filter("n >= 2").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("above"), 2)).alias("spread"), F.sum(F.col("above") * (1 - F.col("above"))).alias("chance"), F.sum(F.col("n") * F.col("above") * (1 - F.col("above"))).alias("all")).first()
    if not r["n"] or not r["all"]:
        return 10.0
    between = (r["spread"] - r["chance"]) / r["n"]
    whole = r["all"] / r["n"]
    return float(min(1e6, max(1.0, whole / between - 1))) if between > 0 else 1e6


def posteriors(p: DataFrame) -> DataFrame:
    """p(doc_id, host, path, p) with host_rate, path_rate (of the path's other documents) and posterior."""
    p = cut(p)
    rate = p.agg(F.avg("p")).first()[0]
    rate = min(1 - 1e-6, max(1e-6, 0.5 if rate is None else rate))
    paths = cut(p.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    hosts = cut(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("above", F.lit(rate)))
    k = strength(hosts)
    hosts = hosts.select(F.col("host").alias("h"), ((k * F.col("above") + F.col("s")) / (k + F.col("n"))).alias("above"))
    joined = cut(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"))
    m = strength(joined)
    sites = joined.select(F.col("host").alias("h"), F.col("path").alias("q"), F.col("n").alias("__n"), F.col("s").alias("__s"), F.col("above").alias("host_rate"))
    logit = lambda c: F.log(F.greatest(c, F.lit(1e-6)) / F.greatest(1 - c, F.lit(1e-6)))
    out = p.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    out = out.withColumn("path_rate", (m * F.col("host_rate") + F.col("__s") - F.col("p")) / (m + F.col("__n") - 1))
    odds = logit(F.col("p")) + logit(F.col("path_rate")) - logit(F.lit(rate))
    return out.withColumn("posterior", 1 / (1 + F.exp(-odds))).select("doc_id", "host", "path", "p", "host_rate", "path_rate", "posterior")


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    found = posteriors(evidence(docs, fit(docs, table(spark, sf_dir, "labels"))))
    r = lambda c: F.round(c, 6).alias(c)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "host", "path", r("p"), r("host_rate"), r("path_rate"), F.round("posterior", 6).alias("score"), (F.col("posterior") >= KEEP).cast("int").alias("predicted"), (F.col("posterior") >= KEEP).alias("kept"))
