"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Characters are 11-bit symbols (ASCII as it is with digits as one, Latin letters,
all other code points by their remainder, so that no two scripts meet in a few
symbols), and an n-gram of order 5 is one long. Spark counts the n-grams
of all trusted documents; continuation counts, discounts and context weights
are group-bys and joins of the count tables, order by order. The finished model
is written in shards by the two symbols before the predicted one: all orders of
a prediction are in one shard. Tasks join their texts with one shard after
another and sum the log probabilities of a document, so no text is shuffled and
no task holds more than a shard.

A tenth of the trusted documents is left out of the counts and sets the upper
limits; the others, which the model knows and finds likelier, set the lower
ones. The logarithms of perplexities are centred by language. A language's
quantiles of what remains are drawn towards those of all languages by ``weight``
documents, and those towards a normal distribution's by as many; each limit is
``margin`` standard deviations wider at every size, so a language of few
documents is judged by its own level and the common spread. Junk is unlikely
text (above the upper limit) or text that repeats itself (below the lower one).

Edge cases: null and empty texts have no perplexity (null) and are not kept; a
null language is a language of its own; a language without calibration
documents has the common level; without trusted text there are no limits and
every document with text is kept; several labels of one id count as trusted if
all of them are.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.code_table import CodeTable
from riskweave.llm.common import exclusive_sum, small_if, staged, text_column, text_slices
from riskweave.session import scratch_path

ORDER, WIDTH = 5, 11
EXTRA = "àáâãäåæçèéêëìíîïñòóôõöøœùúûüýÿßÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØŒÙÚÛÜÝ"
SYMBOLS = 1 << WIDTH
OTHERS = 190  # symbols from here on: code points beyond Latin letters


#: Deals pairs of symbols to shards, alike in Spark and in numpy.
SPREAD, PRIME = 40503, 65521


def symbol_table() -> np.ndarray:
    """Symbols of code points; 0 is kept for what stands before a text."""
    table = np.arange(0x3000) % (SYMBOLS - OTHERS) + OTHERS
    table[:128] = np.arange(1, 129)
    table[ord("0"):ord("9") + 1] = ord("0") + 1
    for k, c in enumerate(EXTRA):
        table[ord(c)] = 129 + k
    return table.astype(np.int64)


_TABLE = symbol_table()


def ngram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The order-5 code of every character of all texts, and the texts' offsets."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)],
                       points.astype(np.int64) % (SYMBOLS - OTHERS) + OTHERS)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = exclusive_sum(lengths)
    pad = ORDER - 1
    place = np.arange(len(symbols)) + np.repeat(np.arange(1, len(texts) + 1) * pad, lengths)
    line = np.zeros(len(symbols) + pad * len(texts), np.int64)
    line[place] = symbols
    code = np.zeros(len(symbols), np.int64)
    for k in range(ORDER):
        code |= line[place - k] << (WIDTH * k)
    return code, offsets


def mask(order: int) -> int:
    return (1 << (WIDTH * order)) - 1


def count_ngrams(texts: DataFrame) -> DataFrame:
    """(code, n) of the order-5 n-grams of all texts."""
    def run(batches):
        held: list = []

        def merge():
            codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)
        for batch in batches:
            for rows in text_slices(batch, "text", 1 << 20):
                code, _ = ngram_codes(rows.column("text").to_pylist())
                if len(code):
                    held.append(np.unique(code, return_counts=True))
                if sum(len(c) for c, _ in held) > 2_000_000:
                    held = [merge()]
                    if len(held[0][0]) > 1_000_000:  # bounded: what is counted so far goes on to the shuffle
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["code", "n"])
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merge()], names=["code", "n"])
    return staged(texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "kn-counts")


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of an order from its counts of counts."""
    n = {r["m"]: r["k"] for r in counts.groupBy(F.least("n", F.lit(5)).alias("m")).agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (n.get(k, 0) for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    each = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.01), k - 0.01 * (k > 1)) if 0 < d else 0.5 for k, d in enumerate(each, 1)]


@dataclass
class Model:
    """A folder of shards: (key, value) with the order (n-grams) or 16 + order (contexts) above the code."""

    folder: str
    shards: int
    unseen: float  # log probability of a symbol in no table


def train(texts: DataFrame, shard_rows: int = 2_000_000) -> Model:
    """Count, discount and interpolate; lower orders use continuation counts."""
    spark = texts.sparkSession
    tables = {ORDER: count_ngrams(texts)}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = staged(tables[k + 1].groupBy((F.col("code").bitwiseAND(mask(k))).alias("code"))
                           .agg(F.count("*").alias("n")), f"kn-continue-{k}")
    below, rows, unseen = None, [], -np.log(SYMBOLS)
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts(tables[k])
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        grams = tables[k].select("code", "n", F.shiftright("code", WIDTH).alias("context"), cut.alias("cut"))
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("given"))
        if k == 1:
            one = contexts.first()
            if one is None:
                return Model("", 0, unseen)
            unseen = float(np.log(max(one["given"] / one["total"] / SYMBOLS, 1e-12)))
        joined = grams.join(contexts, "context").withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
        if k == 1:
            p = joined.withColumn("p", F.col("own") + F.lit(float(np.exp(unseen))))
        else:
            p = (joined.withColumn("shorter", F.col("code").bitwiseAND(mask(k - 1)))
                 .join(below.select(F.col("code").alias("shorter"), F.col("p").alias("lower")), "shorter")
                 .withColumn("p", F.col("own") + F.col("given") / F.col("total") * F.col("lower")))
        below = staged(p.select("code", "p"), f"kn-order-{k}")
        rows.append(below.select(F.lit(k).alias("kind"), "code", F.log("p").cast("float").alias("value")))
        if k > 1:
            rows.append(contexts.select(F.lit(16 + k - 1).alias("kind"), F.col("context").alias("code"),
                                        F.log(F.col("given") / F.col("total")).cast("float").alias("value")))
    model = rows[0]
    for r in rows[1:]:
        model = model.union(r)
    n = sum(tables[k].count() for k in tables)
    shards = max(1, -(-2 * n // shard_rows))
    # The two symbols before the predicted one; the shortest tables go to every shard.
    before = F.when(F.col("kind") < 16, F.shiftright("code", WIDTH)).otherwise(F.col("code")).bitwiseAND(mask(2))
    short = F.col("kind").isin(1, 2, 17)
    key = F.shiftleft(F.col("kind").cast("long"), 56).bitwiseOR(F.col("code")).alias("key")
    dealt = before * F.lit(SPREAD) % F.lit(PRIME) % F.lit(shards)
    model = model.withColumn("shard", F.when(short, -1).otherwise(dealt).cast("int"))
    folder = scratch_path(spark, "llm-kn-shards")
    model.select("shard", key, "value").repartition("shard").write.partitionBy("shard").parquet(folder)
    return Model(folder, shards, unseen)


def _read(uri: str) -> pa.Table | None:
    fs, path = pafs.FileSystem.from_uri(uri)
    files = [f for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.ParquetFile(fs.open_input_file(f.path)).read() for f in files]) if files else None


class Reader:
    """Shards as lookup tables; at most ``held`` of them stay in memory."""

    def __init__(self, model: Model, held: int = 2):
        self.model, self.held, self.cache = model, held, {}
        self.short = _read(f"{model.folder}/shard=-1")

    def table(self, shard: int) -> CodeTable:
        if shard not in self.cache:
            while len(self.cache) >= self.held:
                self.cache.pop(next(iter(self.cache)))
            both = [t for t in (self.short, _read(f"{self.model.folder}/shard={shard}")) if t is not None]
            self.cache[shard] = CodeTable(*(np.concatenate([t[c].to_numpy() for t in both]) for c in ("key", "value")))
        return self.cache[shard]

    def log_probabilities(self, code: np.ndarray) -> np.ndarray:
        """Of every character given up to four before it."""
        out = np.empty(len(code), np.float64)
        shard = ((code >> WIDTH) & mask(2)) * SPREAD % PRIME % self.model.shards
        present = [0] if self.model.shards == 1 else np.unique(shard).tolist()
        # Those in memory first, so that each is read once a slice at most.
        for s in sorted(present, key=lambda s: s not in self.cache):
            at = np.flatnonzero(shard == s) if self.model.shards > 1 else slice(None)
            out[at] = self._of(self.table(s), code[at])
        return out

    def _of(self, table, code):
        total = np.zeros(len(code))
        open_ = np.arange(len(code))
        for k in range(ORDER, 0, -1):
            part = code[open_]
            p = table.find((part & mask(k)) | (k << 56))
            hit = ~np.isnan(p)
            total[open_[hit]] += p[hit]
            open_, part = open_[~hit], part[~hit]
            if not len(open_):
                return total
            if k > 1:
                total[open_] += np.nan_to_num(table.find(((part >> WIDTH) & mask(k - 1)) | ((16 + k - 1) << 56)))
        total[open_] += self.model.unseen
        return total


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """kept (a struct of all columns but ``text``), n_scored and perplexity (null without text) of every document."""
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("kept"), text_column().alias("text"))
    kept = inner.schema["kept"].dataType.simpleString()

    def run(batches):
        reader = Reader(model) if model.folder else None
        for batch in batches:
            for rows in text_slices(batch, "text", 1 << 20):
                code, offsets = ngram_codes(rows.column("text").to_pylist())
                total = exclusive_sum_float(reader.log_probabilities(code)) if reader else np.zeros(len(code) + 1)
                n = np.diff(offsets)
                mean = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([rows.column("kept"), pa.array(n), pa.array(np.exp(-mean), mask=n == 0)],
                                                 names=["kept", "n_scored", "perplexity"])
    return inner.mapInArrow(run, f"kept {kept}, n_scored long, perplexity double")


def exclusive_sum_float(values: np.ndarray) -> np.ndarray:
    return np.append(0.0, np.cumsum(values))


def calibration(doc_id: str = "doc_id") -> Column:
    """The tenth of the trusted documents whose perplexities set the limits."""
    return F.pmod(F.xxhash64(F.col(doc_id), F.lit(11)), F.lit(10)) == 0


def quality(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """doc_id, lang, perplexity, low_limit, high_limit, keep of every document."""
    judged = judge(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"), labels, **limits)
    return judged.select("kept.doc_id", "kept.lang", "perplexity", "low_limit", "high_limit", "keep")


def judge(docs: DataFrame, labels: DataFrame, low: float = 0.005, high: float = 0.995, prior: float = 100.0,
          weight: float = 100.0, margin: float = 0.5) -> DataFrame:
    """kept (a struct of all columns but ``text``), perplexity, limits and keep; texts need doc_id and lang beside them.

    A short text's perplexity is uncertain: its logarithm is drawn towards the
    language's mean by ``prior`` characters before it is held against the limits.
    """
    trusted = staged(labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
                     .agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id"), "kn-trusted")
    train_ids = small_if(trusted.filter(~calibration()))
    model = train(docs.select("doc_id", "text").join(train_ids, "doc_id", "left_semi").select(text_column().alias("text")))
    held = docs.select("doc_id", "lang", "text").join(small_if(trusted), "doc_id", "left_semi")
    known = staged(perplexities(held, model).filter("perplexity is not null")
                   .select("kept.lang", "n_scored", F.log("perplexity").alias("x"), calibration("kept.doc_id").alias("left_out")),
                   "kn-calibration")
    scored = perplexities(docs, model)
    seen, unseen = (_levels(known.filter(rows), (low, high), prior, weight, margin) for rows in ("not left_out", "left_out"))
    if seen is None or unseen is None:
        none = F.lit(None).cast("double")
        return scored.select("kept", "perplexity", none.alias("low_limit"), none.alias("high_limit"),
                             F.col("perplexity").isNotNull().alias("keep"))
    judged = scored.withColumn("x", F.log("perplexity"))
    for (table, common), side in ((seen, "low"), (unseen, "high")):
        own = table.select("of_lang", "mean", f"{side}_limit")
        judged = (judged.join(own, F.col("kept.lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")
                  .fillna({c: common[c] for c in ("mean", f"{side}_limit")})
                  .withColumn(f"drawn_{side}", F.exp(F.col("mean") + _drawn(prior))).drop("mean"))
    inside = (F.col("drawn_low") >= F.col("low_limit")) & (F.col("drawn_high") <= F.col("high_limit"))
    return judged.select("kept", "perplexity", "low_limit", "high_limit", F.coalesce(inside, F.lit(False)).alias("keep"))


def _drawn(prior: float) -> Column:
    return (F.col("x") - F.col("mean")) * F.col("n_scored") / (F.col("n_scored") + prior)


def _levels(known: DataFrame, shares: tuple, prior: float, weight: float, margin: float):
    """(of_lang, mean, low_limit, high_limit) by language, and the same for languages that are not there; None without rows."""
    mean_all = known.agg(F.avg("x")).first()[0]  # one number
    if mean_all is None:
        return None
    means = small_if(staged(known.groupBy(F.col("lang").alias("of_lang")).agg(F.avg("x").alias("mean")), "kn-means"))
    rest = staged(known.join(means, F.col("lang").eqNullSafe(F.col("of_lang"))).select("of_lang", "mean", _drawn(prior).alias("r")),
                  "kn-rest")
    q = F.percentile_approx("r", list(shares), 100_000)
    own_all, sd, n_all = rest.agg(q, F.stddev_pop("r"), F.count("r")).first()  # four numbers
    pooled = [(n_all * own + weight * NormalDist().inv_cdf(p) * sd) / (n_all + weight) for own, p in zip(own_all, shares)]
    n = F.col("n")

    def limit(k):
        return F.exp(F.col("mean") + (n * F.col("q")[k] + weight * pooled[k]) / (n + weight) + (2 * k - 1) * margin * sd)
    by_lang = (rest.groupBy("of_lang").agg(F.first("mean").alias("mean"), F.count("*").alias("n"), q.alias("q"))
               .select("of_lang", "mean", limit(0).alias("low_limit"), limit(1).alias("high_limit")))
    common = {"mean": mean_all, "low_limit": float(np.exp(mean_all + pooled[0] - margin * sd)),
              "high_limit": float(np.exp(mean_all + pooled[1] + margin * sd))}
    return small_if(staged(by_lang, "kn-limits")), common
