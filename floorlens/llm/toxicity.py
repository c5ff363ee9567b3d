"""Toxicity scores of text restored by a noisy channel.

A disguised word (digits and signs for letters, letters set apart, letters repeated) is a
lattice: each observed character may stand for itself, for a letter that it resembles, or
for nothing. The Viterbi path under a trigram model of characters, counted over all
documents, restores it. Words without such a character have one path and stay as they are.

Restored text is scored by evidence of words and word beginnings, learned from labelled
documents: log odds of a document being toxic, lowered by their standard error. A document's
sums of evidence enter a logistic regression fitted on evidence from the other half of the
labelled documents, so that it sees evidence as unseen documents have it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import stored

#: Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou",
}
#: Costs, in units of -ln(probability), of a sign for a letter, a sign for nothing, a sign between words, a letter written
#: once too often (in a run of three or more, in one of two), and letters set apart that belong together or do not.
SIGN_COST, NOTHING_COST, BREAK_COST, THIRD_COST, SECOND_COST, JOIN_COST, APART_COST = 1.0, 9.0, 8.0, 0.3, 6.0, 0.4, 5.0
_L = "a-zà-öø-ÿ"
_S = re.escape("".join(LOOKALIKES))
_TOKEN = re.compile(f"[{_L}{_S}]+")
_WORD = re.compile(f"[{_L}]+")
#: Single letters or signs, one or two separators apart, three or more of them.
_APART = re.compile(rf"(?<![{_L}{_S}])[{_L}{_S}](?:[ ._\-]{{1,2}}[{_L}{_S}](?![{_L}{_S}])){{2,}}")
_THRICE = re.compile(rf"([{_L}])\1\1")
#: A lattice is decoded in pieces of so many characters; the path of one ends where the next begins.
PIECE = 256
ROWS_AT_ONCE, FEATURES_AT_ONCE = 100, 100_000
#: Symbols of the character model: 0 for all that is no letter, then letters.
LETTERS = [chr(c) for c in (*range(97, 123), *range(0xE0, 0xF7), *range(0xF8, 0x100))]
SYMBOLS = len(LETTERS) + 1
_SYMBOL = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODE = np.zeros(256, np.int64)
_CODE[[ord(c) for c in LETTERS]] = np.arange(1, SYMBOLS)


def trigram_codes(text: str) -> np.ndarray:
    """Codes of three symbols in a row, of the lower-cased text between two breaks; breaks are merged."""
    symbols = _CODE[np.frombuffer(f" {text.lower()} ".encode("latin-1", "replace"), np.uint8)]
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
    symbols = symbols[kept]
    return (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows (code, n) over all texts: at most SYMBOLS^3 of them, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for value in batch["text"]:
                value = value.as_py()
                for at in range(0, len(value), 1 << 20):
                    held.append(trigram_codes(value[at : at + (1 << 20)]))
                    size += len(held[-1])
                    if size > 1 << 21:
                        total += np.bincount(np.concatenate(held), minlength=len(total))
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        codes = np.flatnonzero(total)
        yield pa.record_batch({"code": codes, "n": total[codes]})

    texts = df.select(F.col(text).cast("string").alias("text")).where("text is not null")
    return texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_costs(counts: np.ndarray) -> np.ndarray:
    """-ln P(symbol | two before), by [first, second, symbol]: trigrams backed by bigrams, these by single symbols."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p = (one + 1) / (one.sum() + SYMBOLS)
    p = (two + 20 * p) / (two.sum(1, keepdims=True) + 20)
    p = (three + 20 * p) / (three.sum(2, keepdims=True) + 20)
    return -np.log(p)


def lattice(span: str, apart: bool) -> list[list[tuple[str, float]]]:
    """What each character of a span may stand for, with costs. `apart`: letters with separators between them."""
    out = []
    for i, c in enumerate(span):
        if c in _SYMBOL:
            options = [(c, 0.0)]
            if i and span[i - 1] == c:
                stretched = span[max(0, i - 2) : i] == c * 2 or span[i - 1 : i + 2] == c * 3
                options.append(("", THIRD_COST if stretched else SECOND_COST))
        elif c in LOOKALIKES:
            options = [(x, SIGN_COST) for x in LOOKALIKES[c]] + [("", NOTHING_COST), (" ", BREAK_COST)]
        else:
            options = [("", JOIN_COST), (" ", APART_COST if apart else 0.0)]
        out.append(options)
    return out


class Memory(dict):
    """Values of a function, remembered; forgotten in whole when there are many. Long keys are not kept."""

    LIMIT, LONGEST = 200_000, 64

    def __init__(self, function: Callable):
        super().__init__()
        self.function = function

    def __missing__(self, key: str) -> object:
        value = self.function(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[key] = value
        return value


class Decoder:
    """Restores lower-cased text under the costs of `character_costs`. What it remembers of tokens is bounded."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.tokens = Memory(self.token)
        self.parts = Memory(lambda token: tuple(_WORD.findall(self.tokens[token])))

    def viterbi(self, span: str, apart: bool = False) -> str:
        """The cheapest reading of a span between two breaks. Of equal ones that with the least text."""
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        done = []
        options = lattice(span, apart)
        for i, choices in enumerate(options):
            ahead: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, text) in paths.items():
                for letter, more in choices:
                    if letter == "":
                        state, total, read = (a, b), cost + more, text
                    else:
                        c = _SYMBOL.get(letter, 0)
                        if not c and not b:  # breaks are merged
                            state, total, read = (a, b), cost + more, text
                        else:
                            state, total, read = (b, c), cost + more + self.costs[a][b][c], text + letter
                    if state not in ahead or (total, read) < ahead[state]:
                        ahead[state] = (total, read)
            paths = ahead
            if (i + 1) % PIECE == 0 and i + 1 < len(options):
                state, (cost, text) = min(paths.items(), key=lambda x: x[1])
                done.append(text)
                paths = {state: (0.0, "")}
        ends = [(cost + (self.costs[a][b][0] if b else 0.0), text) for (a, b), (cost, text) in paths.items()]
        return "".join(done) + min(ends)[1]

    def token(self, token: str) -> str:
        """A run of letters and signs, restored if it is a disguised word."""
        core = token.strip("!|+*")
        if not any(c in _SYMBOL for c in core):
            return token
        if core.isalpha() and not _THRICE.search(core):
            return core
        return self.viterbi(core)

    def joined(self, text: str) -> str:
        """Lower-cased text with letters that were set apart put together where the model says so."""

        def together(m: re.Match) -> str:
            span = m.group()
            return self.viterbi(span, True) if sum(c in _SYMBOL for c in span) > 1 else span

        return _APART.sub(together, text.lower())

    def restored(self, text: str) -> str:
        return _TOKEN.sub(lambda m: self.tokens[m.group()], self.joined(text))

    def words(self, text: str) -> dict[str, int]:
        """Counts of the words of `restored(text)`."""
        out: dict[str, int] = {}
        for token, n in Counter(_TOKEN.findall(self.joined(text))).items():
            for word in self.parts[token]:
                out[word] = out.get(word, 0) + n
        return out


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows some hundred at a time: only so many documents' words are held as Python values."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(first, ROWS_AT_ONCE)


def features_of(word: str) -> list[str]:
    """The word with an end mark, and its beginnings of 4 to 8 letters."""
    return [word[:40] + "$", *(word[:n] for n in range(4, min(8, len(word)) + 1))]


def evidence(features: DataFrame, toxic: int, clean: int, lowered: float = 1.5, least: float = 0.7) -> DataFrame:
    """Rows (feature, weight) of rows (feature, t, c): numbers of toxic and clean documents with it, of
    so many. A weight is the log odds ratio less `lowered` standard errors."""
    t, c = F.col("t"), F.col("c")
    cells = [t + 0.5, F.lit(toxic) - t + 0.5, c + 0.5, F.lit(clean) - c + 0.5]
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    error = F.sqrt(sum((1 / x for x in cells[1:]), 1 / cells[0]))
    return features.select("feature", (odds - lowered * error).alias("weight")).where((t >= 2) & (F.col("weight") > least))


class Evidence:
    """Evidence sums of a document's words."""

    NAMES = ("total", "largest", "length", "rate", "spread")

    def __init__(self, weights: dict[str, float]):
        self.of = Memory(lambda word: max((weights.get(f, 0.0) for f in features_of(word)), default=0.0))

    def sums(self, words: dict[str, int]) -> list[float]:
        found = [(value, n) for value, n in zip(map(self.of.__getitem__, words), words.values(), strict=True) if value]
        length = sum(words.values())
        # exact sums, so that they do not depend on the order of words
        total, weighted = math.fsum(v for v, _ in found), math.fsum(v * n for v, n in found)
        largest = max((v for v, _ in found), default=0.0)
        return [total, largest, math.log1p(length), weighted / math.sqrt(length + 1), total / math.log(length + 3)]


def _name_hash(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def held_out(key: str = "doc_id") -> Column:
    """Documents that no label is learned from; a null key is the empty text."""
    return _name_hash(key) % 3 == 1


class ToxicityModel:
    """Character costs, evidence weights and the regression; bounded, whatever the corpus."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float], coefficients: list[float], intercept: float):
        self.costs, self.weights, self.coefficients, self.intercept = costs, weights, coefficients, intercept

    def score(self, sums: list[float]) -> float:
        z = self.intercept + sum(a * b for a, b in zip(self.coefficients, sums, strict=True))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit(documents: DataFrame, labels: DataFrame, most_labelled: int = 40_000, most_weights: int = 50_000) -> ToxicityModel:
    """Learn the model. Characters are counted over all documents. Evidence and regression come
    from the labelled documents that are not held out: all of them, or about `most_labelled` by
    their key's hash if there are more. The `most_weights` features of most weight are kept.

    A document with several labels is toxic if one says so; null labels and keys do not count.
    Without a toxic or without a clean labelled document every score is the toxic share.
    """
    spark = documents.sparkSession
    counts = np.zeros(SYMBOLS**3, np.int64)
    found = trigram_counts(documents).toArrow()
    counts[found["code"].to_numpy()] = found["n"].to_numpy()
    costs = character_costs(counts)

    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("k")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out("k"))
    share = min(1.0, most_labelled / max(1, known.count()))
    fold = F.crc32(F.concat(F.lit("fold:"), F.col("k").cast("string")).cast("binary"))
    known = known.withColumn("fold", (fold % 2).cast("int")).where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # about `most_labelled` keys at most: small enough to send to every task, so that no text is shuffled
    texts = texts.join(F.broadcast(known), F.col("doc_id") == F.col("k")).select("text", "toxic", "fold")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        for batch in slices(batches):
            rows = [decoder.words(x.as_py()) for x in batch["text"]]
            kinds = pa.list_(pa.string()), pa.list_(pa.int32())
            columns = [pa.array([list(x) for x in rows], kinds[0]), pa.array([list(x.values()) for x in rows], kinds[1])]
            yield pa.record_batch([*columns, batch["toxic"], batch["fold"]], names=["words", "times", "toxic", "fold"])

    sample = stored(texts.mapInArrow(read, "words array<string>, times array<int>, toxic int, fold int"), "toxicity_sample")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = ([sizes.get((f, y), 0) for f in (0, 1)] for y in (1, 0))
    if not sum(toxic) or not sum(clean):
        return ToxicityModel(costs, {}, [0.0] * len(Evidence.NAMES), 40.0 if sum(toxic) else -40.0)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ys, folds = [], [], []

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(names, pa.string()), pa.array(ys, pa.int32()), pa.array(folds, pa.int32())], names=["feature", "toxic", "fold"])
            names.clear(), ys.clear(), folds.clear()
            return batch

        for batch in slices(batches):
            for words, y, part in zip(*(batch[c].to_pylist() for c in ("words", "toxic", "fold")), strict=True):
                found = {f for w in words for f in features_of(w)}
                names += found
                ys += [y] * len(found)
                folds += [part] * len(found)
                if len(names) > FEATURES_AT_ONCE:
                    yield out()
        yield out()

    one = sample.select("words", "toxic", "fold").mapInArrow(features, "feature string, toxic int, fold int")
    per = [F.sum(((F.col("fold") == f) & (F.col("toxic") == y)).cast("long")).alias(f"n{f}{y}") for f in (0, 1) for y in (0, 1)]
    table = stored(one.groupBy("feature").agg(*per).where("n01 + n11 >= 2"), "toxicity_features")

    def weights(t: Column, c: Column, n_toxic: int, n_clean: int) -> dict[str, float]:
        rows = evidence(table.select("feature", t.alias("t"), c.alias("c")), n_toxic, n_clean)
        return {r["feature"]: r["weight"] for r in rows.orderBy(F.desc("weight"), "feature").limit(most_weights).collect()}

    every = weights(F.col("n01") + F.col("n11"), F.col("n00") + F.col("n10"), sum(toxic), sum(clean))
    halves = [weights(F.col(f"n{f}1"), F.col(f"n{f}0"), toxic[f], clean[f]) for f in (0, 1)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [Evidence(halves[1]), Evidence(halves[0])]
        for batch in slices(batches):
            rows = zip(*(batch[c].to_pylist() for c in ("words", "times", "fold")), strict=True)
            found = [others[part].sums(dict(zip(words, times, strict=True))) for words, times, part in rows]
            yield pa.record_batch([pa.array(found, pa.list_(pa.float64())), batch["toxic"]], names=["sums", "toxic"])

    rows = stored(sample.mapInArrow(sums, "sums array<double>, toxic int"), "toxicity_sums")
    rows = rows.select(array_to_vector("sums").alias("features"), F.col("toxic").cast("double").alias("label"))
    fitted = LogisticRegression(maxIter=40, regParam=1e-4).fit(rows)
    return ToxicityModel(costs, every, [float(x) for x in fitted.coefficients], float(fitted.intercept))


def restored(documents: DataFrame, model: ToxicityModel, text: str = "text", name: str = "restored") -> DataFrame:
    """`documents` with a column `name`: the lower-cased text with disguised words restored; null stays null."""

    @F.pandas_udf("string")
    def restore(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(model.costs)
        for part in parts:
            yield part.map(lambda x: None if x is None else decoder.restored(x))

    return documents.withColumn(name, restore(F.col(text)))


def scored(documents: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of `documents`.

    Only the text is an input of the score: a null text is an empty one, repeated rows and
    equal texts get equal scores, other columns are left out, an empty table gives none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, found = Decoder(model.costs), Evidence(model.weights)
        for batch in batches:
            scores = [model.score(found.sums(decoder.words(x.as_py()))) for x in batch["text"]]
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = documents.select("doc_id", held_out().alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(read, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
