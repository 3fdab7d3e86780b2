"""Toxicity by a noisy channel: restore disguised words, then score the restored text.

1. A character trigram model is counted over the words of all documents.
2. A suspicious token (digits or signs between letters, separators inside, a
   letter two times in a row, look-alike letters, or a run of single letters)
   of any length becomes a lattice: each character may stand for itself, for a
   letter it imitates, for a repetition, or for nothing. The Viterbi path over
   all states, under channel costs and the character model, is the restored
   word; parts between
   separators are restored by themselves too. Surface words stay beside it, and
   two or three neighbouring tokens count as the evidence word they make up.
3. Evidence: for whole words and word beginnings, the share of toxic labels
   among labelled documents that hold them, drawn towards the base rate. Copies
   of one document count once (least hash of five words). A document's inputs are the
   strongest three of its words; a logistic fit with every training document's
   own part taken out gives the score.

The classifier is fitted on at most ``max_labelled`` labelled rows (chosen by a
hash of their id) outside the held-out fold, and every cue that passes the test
of evidence counts; the character model and the scores cover all documents. Inputs of a score: the text, nothing else.

Edge cases: null and empty texts have no words and get the score of no evidence;
a null id is not held out; several labels of one id count as toxic if one is;
null labels are no labels; if the training rows lack one of the two labels,
every document gets the share of toxic rows among them (0 without any); an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import small_if, staged, text_column, text_slices
from riskweave.llm.ngram_join import shingle_sets

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøœùúûüýÿß"
OTHER, SIZE = 62, 64  # symbol 0 is the edge of a word
#: Signs that imitate letters (fixed values).
IMITATIONS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
              "%": "o", "#": "h", "*": "aeiou", "?": "aeiou", "а": "a", "е": "e", "о": "o", "с": "c", "р": "p", "і": "i"}
COST_IMITATE, COST_DROP, COST_REPEAT, COST_KEEP = 1.0, 0.7, 0.2, 6.0
BASE_WEIGHT = 5.0
TOP = 3  # a document's strongest words
LEAST_RATIO = 30.0
WORD = re.compile(r"[^\W\d_]+")
SUSPECT = re.compile(r"[^\W\d_](?:[^\w\s]|[\d_])|(?:[^\w\s]|[\d_])[^\W\d_]|([^\W\d_])\1")
DOUBLED = re.compile(r"(.)\1", re.DOTALL)
TRIPLED = re.compile(r"(.)\1\1", re.DOTALL)
STRIPPED = ".,;:\"'()[]{}"
LOOKALIKES = frozenset(c for c in IMITATIONS if c.isalpha())
SEPARATORS = re.compile(r"[._,;:/\\~=&'\"-]+")


def symbol_table() -> np.ndarray:
    table = np.full(0x3000, OTHER, np.int64)
    for k, c in enumerate(LETTERS):
        table[ord(c)] = k + 1
    return table


class CharModel:
    """Trigram log probabilities, each order drawn towards the lower one."""

    def __init__(self, counts: np.ndarray):
        n3 = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
        p1 = (n1 + 1) / (n1.sum() + SIZE)
        p2 = (n2 + 5 * p1) / (n2.sum(axis=1, keepdims=True) + 5)
        p3 = (n3 + 5 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).astype(np.float32)
        self.code = {c: k + 1 for k, c in enumerate(LETTERS)}
        # Of "qccr": is it cheaper to keep both c than to read one of them as a repetition?
        c = np.arange(SIZE)
        twice = self.cost[:, c, c][:, :, None] + self.cost[c, c, :][None]
        self.twice = (twice <= self.cost + np.float32(COST_REPEAT)).tobytes()

    def undoubled(self, token: str) -> str:
        """The cheapest reading of letters of which none stands three times in a row.

        A doubled letter changes no trigram beyond the letter after it, so each is decided by itself.
        """
        code = [0, *(self.code.get(c, OTHER) for c in token), 0]
        out = []
        for i, c in enumerate(token, 1):
            if i == 1 or c != token[i - 2] or self.twice[(code[i - 2] * SIZE + code[i]) * SIZE + code[i + 1]]:
                out.append(c)
        return "".join(out)

    def decode(self, token: str) -> str:
        """The cheapest reading of a token's lattice."""
        if token.isalpha() and LOOKALIKES.isdisjoint(token) and not TRIPLED.search(token):
            return self.undoubled(token)
        return self.viterbi(re.sub(r"([^\W\d_])\1{3,}", r"\1\1\1", token))

    def viterbi(self, token: str) -> str:
        """The cheapest path; a state is the last two letters, at most 64**2 of them, and none is left out."""
        paths = {(0, 0): (0.0, None)}  # cost, and the letters so far, last one first
        edge = re.match(r"\W*", token).end(), len(token) - len(re.search(r"\W*$", token).group())
        never, model = (math.inf, None), self.cost
        for i, c in enumerate(token):
            step: dict = {}
            letter = self.code.get(c, OTHER if c.isalpha() else 0)
            if letter and c not in IMITATIONS:
                again = i and token[i - 1] == c
                for (a, b), (cost, text) in paths.items():
                    new = cost + model.item(a, b, letter)
                    if new < step.get((b, letter), never)[0]:
                        step[b, letter] = new, (c, text)
                    if again and text and text[0] == c and cost + COST_REPEAT < step.get((a, b), never)[0]:
                        step[a, b] = cost + COST_REPEAT, text
            else:
                meant = [(x, self.code[x]) for x in IMITATIONS.get(c, "")]
                drop = COST_DROP if not c.isalnum() or not edge[0] <= i < edge[1] else COST_KEEP
                for (a, b), (cost, text) in paths.items():
                    for x, k in meant:
                        new = cost + COST_IMITATE + model.item(a, b, k)
                        if new < step.get((b, k), never)[0]:
                            step[b, k] = new, (x, text)
                    if cost + drop < step.get((a, b), never)[0]:
                        step[a, b] = cost + drop, text
            paths = step

        def spelled(text):
            letters = []
            while text:
                letters.append(text[0])
                text = text[1]
            return "".join(reversed(letters))
        ends = [(cost + model.item(a, b, 0), text) for (a, b), (cost, text) in paths.items()]
        least = min(cost for cost, _ in ends)
        return min(spelled(text) for cost, text in ends if cost == least)


def suspicious(token: str) -> bool:
    """Whether a token may be a disguised word; look-alike letters count beside Latin ones or alone."""
    return bool(SUSPECT.search(token)) or (not LOOKALIKES.isdisjoint(token) and all(
        c in LOOKALIKES or c in LETTERS or not c.isalpha() for c in token))


def stretches(word: str) -> list[str]:
    """A long run may hold several words: the whole and every stretch of 3 to 20 letters."""
    return list(dict.fromkeys([word, *(word[i:i + n] for n in range(3, min(21, len(word))) for i in range(len(word) - n + 1))]))


def plain_word(token: str) -> str | None:
    """The word of a token without disguise: letters, none twice in a row, none a look-alike, and marks around them."""
    word = token.strip(STRIPPED)
    if word.isalpha() and not DOUBLED.search(word) and (word.isascii() or LOOKALIKES.isdisjoint(word)):
        return word
    return None


def surface_words(token: str) -> list[str]:
    return WORD.findall(token)


def split_tokens(texts: pa.Array):
    """Lower-case tokens: their distinct strings, the number of each, and the documents' offsets."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.values.dictionary_encode()
    return ([w.lower() for w in coded.dictionary.to_pylist()], np.asarray(coded.indices, dtype=np.int64),
            np.asarray(lists.offsets, dtype=np.int64))


def count_characters(docs: DataFrame) -> CharModel:
    """Trigram counts of all words of all documents; what reaches the driver is at most 64**3 sums."""
    def run(batches):
        table, total = symbol_table(), np.zeros(SIZE ** 3, np.int64)
        for batch in batches:
            for rows in text_slices(batch, "text", 4 << 20):
                tokens, index, _ = split_tokens(rows.column("text"))
                times = np.bincount(index, minlength=len(tokens))
                line = "\0\0".join(tokens)  # two edges: no trigram joins two tokens' letters
                points = np.frombuffer(f"\0\0{line}\0".encode("utf-32-le", "surrogatepass"), np.uint32)
                code = table[np.minimum(points, len(table) - 1)]
                code[points == 0] = 0
                weight = np.repeat(times, [len(t) + 2 for t in tokens]) if tokens else np.zeros(0, np.int64)
                code3 = code[:-2] * SIZE * SIZE + code[1:-1] * SIZE + code[2:]
                ok = (code[2:] > 0) | (code[1:-1] > 0)
                # A trigram belongs to the token that its last symbol is in, or ends.
                n = min(len(code3), len(weight))
                total += np.bincount(code3[:n][ok[:n]], weights=weight[:n][ok[:n]], minlength=SIZE ** 3).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])
    sums = docs.select(text_column().alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE ** 3, np.int64)
    for r in sums.toLocalIterator():
        counts[r["code"]] = r["n"]
    return CharModel(counts)


class Restorer:
    """Words of texts: surface words and decoded ones, with a bounded memo by token."""

    def __init__(self, model: CharModel, most: int = 200_000):
        self.model, self.most, self.memo = model, most, {}

    def token(self, t: str) -> tuple[str, ...]:
        got = self.memo.get(t)
        if got is None:
            if len(self.memo) >= self.most:
                self.memo.clear()
            plain = plain_word(t)
            if plain is not None:
                self.memo[t] = got = (plain,)
                return got
            words = surface_words(t)
            bare = re.sub(r"^([^\w\s])\1+|([^\w\s])\2+$", "", t)  # rows of one sign around a word are decoration
            bare = bare.strip(STRIPPED)
            if suspicious(bare):
                words = [*words, *surface_words(self.model.decode(bare))]
                parts = SEPARATORS.split(bare)
                if len(parts) > 1:
                    for part in parts:
                        if len(part) > 1 and suspicious(part):
                            words += surface_words(self.model.decode(part))
                    for single, run in groupby(parts, lambda part: len(part) == 1):
                        if single and len(run := "".join(run)) >= 3:
                            words += stretches(self.model.decode(run))
            got = self.memo[t] = tuple(dict.fromkeys(words))
        return got

    def spaced(self, tokens: list[str], index: np.ndarray, offsets: np.ndarray) -> list[tuple[int, tuple[str, ...]]]:
        """(document, words) of runs of three or more single characters."""
        single = np.array([len(t.strip(".,;:-_")) == 1 for t in tokens], bool)[index]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        start = np.flatnonzero(single & np.append(True, ~single[:-1] | (doc[1:] != doc[:-1]))) if len(single) else []
        out = []
        for a in start:
            z = a + 1
            while z < len(single) and single[z] and doc[z] == doc[a]:
                z += 1
            if z - a >= 3:
                joint = "".join(tokens[k].strip(".,;:-_") for k in index[a:z])
                out.append((int(doc[a]), tuple(stretches(self.model.decode(joint)))))
        return out

    def forms(self, token: str) -> set[str]:
        """What a token may give to a word that was broken up: itself without marks around it, and its words."""
        return {token.strip(".,;:-_\"'()[]{}"), *self.token(token)} - {""}

    def broken(self, tokens: list[str], part: np.ndarray, index: np.ndarray, offsets: np.ndarray,
               ends: "Endings") -> list[tuple[int, str]]:
        """(document, evidence word) where two or three neighbouring tokens make up an evidence word.

        ``part`` has the parts (:meth:`Endings.parts`) that each of ``tokens`` may be.
        """
        part = part[index]
        first, middle, last = part & FIRST > 0, part & MIDDLE > 0, part & LAST > 0
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        out = []
        for n in (2, 3):
            if len(index) < n:
                continue
            at = first[:len(index) - n + 1] & last[n - 1:] & (doc[:len(index) - n + 1] == doc[n - 1:])
            for k in np.flatnonzero(at & middle[1:-1] if n == 3 else at).tolist():
                raw = [self.forms(tokens[j]) for j in index[k:k + n]]
                joint = {"".join(x) for x in product(*raw)}
                joint.update(self.token("".join(tokens[j] for j in index[k:k + n])))
                out += [(int(doc[k]), w) for w in joint if w in ends.words]
        return out


FIRST, MIDDLE, LAST = 1, 2, 4


class Endings:
    """Proper beginnings, middles and ends of the evidence words of four letters or more."""

    def __init__(self, share: dict[str, float], base: float):
        self.words = {c[1:] for c, p in share.items() if c[0] == "=" and p > base and len(c) > 4}
        self.part: dict[str, int] = {}
        for w in self.words:
            for i in range(len(w)):
                for j in range(i + 1, len(w) + (i > 0)):
                    kind = FIRST if i == 0 else LAST if j == len(w) else MIDDLE
                    self.part[w[i:j]] = self.part.get(w[i:j], 0) | kind

    def parts(self, forms) -> int:
        """FIRST, MIDDLE and LAST together, as far as one of ``forms`` is such a part of an evidence word."""
        found = 0
        for w in forms:
            found |= self.part.get(w, 0)
        return found


def cues(word: str) -> list[str]:
    """What may be evidence of a word: itself and its beginnings."""
    return ["=" + word, *("^" + word[:k] for k in range(4, 7) if len(word) > k)]


def cue_column(word: str) -> Column:
    """The same as :func:`cues`, in Spark."""
    return F.expr(f"concat(array(concat('=', {word})), transform(filter(sequence(4, 6), k -> length({word}) > k), "
                  f"k -> concat('^', left({word}, k))))")


@dataclass
class ToxicModel:
    chars: CharModel
    share: dict[str, float]  # cue -> drawn share of toxic labels
    base: float
    weights: np.ndarray | None

    @cached_property
    def heads(self) -> set[str]:
        """The first four letters of every cue."""
        return {c[1:5] for c in self.share}

    @cached_property
    def endings(self) -> Endings:
        return Endings(self.share, self.base)

    def word(self, word: str) -> float:
        """A word's share: its own, or else that of its beginnings."""
        if word[:4] not in self.heads:
            return 0.0
        whole, *begun = cues(word)
        return self.share[whole] if whole in self.share else max((self.share.get(c, 0.0) for c in begun), default=0.0)

    def probability(self, tops: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(tops), self.base)
        return 1 / (1 + np.exp(-np.clip(inputs(tops) @ self.weights, -500, 500)))


def inputs(tops: np.ndarray) -> np.ndarray:
    p = np.clip(tops, 1e-6, 1 - 1e-6)
    return np.concatenate([np.ones((len(p), 1)), np.log(p / (1 - p))], axis=1)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 40_000, max_cues: int | None = None) -> ToxicModel:
    """Fit on labelled documents outside the held-out fold.

    All cues that pass the test are kept, which the labelled rows bound; a caller may ask for fewer by ``max_cues``.
    """
    chars = count_characters(docs)
    known = (labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).filter(~held_out()))
    n = known.count()
    if n > max_labelled:  # a share of the rows by a hash of their id, a little under the bound
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(0.97e6 * max_labelled / n))
    known = F.broadcast(known)  # at most max_labelled rows of two numbers

    def words(batches):
        restorer = Restorer(chars)
        for batch in batches:
            for rows in text_slices(batch, "text", 4 << 20):
                tokens, index, offsets = split_tokens(rows.column("text"))
                extra: dict[int, list] = {}
                for d, w in restorer.spaced(tokens, index, offsets):
                    extra.setdefault(d, []).extend(w)
                found = []
                for d, (a, z) in enumerate(zip(offsets, offsets[1:])):
                    got = dict.fromkeys(w for k in np.unique(index[a:z]) for w in restorer.token(tokens[k]))
                    found.append(list(got | dict.fromkeys(extra.get(d, []))))
                runs, at = shingle_sets(rows.column("text"))  # sorted: a text's least hash of five words comes first
                group = np.append(runs, np.uint64(0))[np.where(np.diff(at) > 0, at[:-1], len(runs))].view(np.int64)
                yield pa.RecordBatch.from_arrays([rows.column("toxic"), pa.array(group), pa.array(found, pa.list_(pa.string()))],
                                                 names=["toxic", "grp", "words"])
    source = docs.select("doc_id", text_column().alias("text")).join(known, "doc_id").select("text", "toxic")
    rows = staged(source.mapInArrow(words, "toxic int, grp long, words array<string>")
                  .withColumn("row", F.monotonically_increasing_id()), "toxic-words")
    one = rows.groupBy("toxic", "grp").agg(F.min("row").alias("row")).select("row")  # copies of a document once
    rows = staged(rows.join(one, "row"), "toxic-train")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    base = toxic / max(1, toxic + clean)
    if not toxic or not clean:
        return ToxicModel(chars, {}, base, None)
    by_word = rows.select("row", "toxic", F.explode("words").alias("w"))
    by_cue = lambda d: d.select("row", "toxic", F.explode(cue_column("w")).alias("cue")).distinct()
    # No cue of fewer toxic documents can pass the test, even without a clean one; all others are tested.
    fewest = math.ceil(LEAST_RATIO / (2 * math.log(1 / base)))
    often = (by_cue(by_word.filter("toxic = 1")).groupBy("cue").agg(F.count("*").alias("k")).filter(F.col("k") >= fewest)
             .select("cue"))
    often = small_if(staged(often, "toxic-cues"))
    # Whole words first; beginnings then count only where the word is no evidence by itself, so that a
    # beginning is a family of words and not the shadow of one.
    held = by_word.withColumn("cue", F.concat(F.lit("="), F.col("w"))).join(often, "cue").select("row", "toxic", "cue")
    whole = _beyond_chance(held, base, max_cues, "toxic-whole")
    others = by_word.join(whole.select(F.expr("substring(cue, 2)").alias("w")), "w", "left_anti")
    held = others.select("row", "toxic", F.explode(cue_column("w")).alias("cue")).filter("cue like '^%'").join(often, "cue")
    begun = _beyond_chance(held.distinct(), base, max_cues, "toxic-begun")
    counts = small_if(whole.union(begun))
    share = {r["cue"]: (r["k"] + BASE_WEIGHT * base) / (r["k"] + r["c"] + BASE_WEIGHT) for r in whole.union(begun).collect()}
    # Each training document without its own part in the counts.
    drawn = (F.greatest(F.col("k") - F.col("y"), F.lit(0)) + BASE_WEIGHT * base) / (F.col("k") + F.col("c") - 1 + BASE_WEIGHT)
    by_doc = (by_word.select("row", "w", F.col("toxic").alias("y"), F.explode(cue_column("w")).alias("cue")).join(counts, "cue")
              .groupBy("row", "w").agg(F.max_by(drawn, F.struct(F.col("cue").startswith("="), drawn)).alias("p"))
              .groupBy("row").agg(F.slice(F.sort_array(F.collect_list("p"), asc=False), 1, TOP).alias("top")))
    table = rows.select("row", "toxic").join(by_doc, "row", "left").select("toxic", "top").toPandas()
    tops = np.full((len(table), TOP), base)
    for d, t in enumerate(table["top"]):
        if t is not None:
            tops[d, :len(t)] = np.maximum(t, base)
    return ToxicModel(chars, share, base, logistic(inputs(tops), table["toxic"].to_numpy(float)))


def _beyond_chance(held: DataFrame, base: float, most: int | None, name: str) -> DataFrame:
    """(cue, k toxic, c clean) of cues whose share of toxic labels is above the base rate by more than chance.

    Only those ``most`` of the largest likelihood ratio, if that is given.
    """
    counts = held.groupBy("cue").agg(F.sum("toxic").alias("k"), F.sum(1 - F.col("toxic")).alias("c"))
    n = F.col("k") + F.col("c")
    ratio = sum((F.when(F.col(x) > 0, 2 * F.col(x) * F.log(F.col(x) / (n * share))).otherwise(0.0)
                 for x, share in (("k", base), ("c", 1 - base))), F.lit(0.0))
    passed = counts.withColumn("ratio", ratio).filter((F.col("k") > base * n) & (F.col("ratio") >= LEAST_RATIO))
    if most is not None:
        passed = passed.orderBy(F.desc("ratio"), "cue").limit(most)
    return staged(passed.drop("ratio"), name)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.diag([0.0, *np.ones(x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge + 1e-9 * np.eye(len(w)),
                               x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """kept (a struct of all columns of ``docs``), score and predicted of every document; whole texts, no shuffle."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: 64**3 costs, and the cues of at most max_labelled rows
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept"), text_column().alias("text"))

    def run(batches):
        m = shared.value
        restorer, memo, ends = Restorer(m.chars), {}, m.endings
        nothing = (0.0, 0)

        def strength(token):
            """A token's largest share, and the parts of evidence words that it may be."""
            plain = plain_word(token)
            if plain is None:
                return max(map(m.word, restorer.token(token)), default=0.0), ends.parts(restorer.forms(token))
            if plain[:4] in m.heads or plain in ends.part:
                return m.word(plain), ends.part.get(plain, 0)
            return nothing
        for batch in batches:
            for rows in text_slices(batch, "text", 4 << 20):
                tokens, index, offsets = split_tokens(rows.column("text"))
                if len(memo) > 200_000:
                    memo.clear()
                for t in tokens:
                    if t not in memo:
                        memo[t] = strength(t)
                told_of = [memo[t] for t in tokens]
                value = np.fromiter((v for v, _ in told_of), float, len(tokens))
                part = np.fromiter((p for _, p in told_of), np.int64, len(tokens))
                n = len(offsets) - 1
                tops = np.full((n, TOP), m.base)
                doc = np.repeat(np.arange(n), np.diff(offsets))
                strong = np.flatnonzero(value[index] > m.base)
                told: dict[int, dict] = {}
                for d, k in zip(doc[strong].tolist(), index[strong].tolist()):
                    told.setdefault(d, {})[tokens[k]] = value[k]
                for d, words in restorer.spaced(tokens, index, offsets):
                    for w in words:
                        p = m.word(w)
                        if p > m.base:
                            told.setdefault(d, {})[w] = p
                for d, w in restorer.broken(tokens, part, index, offsets, ends):
                    told.setdefault(d, {}).setdefault(w, m.share["=" + w])
                for d, held in told.items():
                    top = sorted(held.values(), reverse=True)[:TOP]
                    tops[d, :len(top)] = top
                p = m.probability(tops)
                yield pa.RecordBatch.from_arrays([rows.column("kept"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 names=["kept", "score", "predicted"])
    kept = inner.schema["kept"].dataType.simpleString()
    return inner.mapInArrow(run, f"kept {kept}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels, **bounds))
    return found.select("kept.doc_id", "score", "predicted").select("doc_id", held_out().alias("held_out"), "score", "predicted")
