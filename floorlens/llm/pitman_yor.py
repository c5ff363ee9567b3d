"""Hierarchical Pitman-Yor language model with Gibbs-sampled seating.

A restaurant for each previous word (at a text's start: the end of a text) serves the words
that follow it. Its parent is the word restaurant, and that one draws its dishes (words, and
the end of a text) from a spelling model, itself a hierarchy of restaurants: one for each
context of two bytes, whose parents are those of one byte, whose parent is the one without
context, above a uniform law. Every table opened in a restaurant is a customer of its parent.
A word that training has not seen gets what the word restaurant gives to new tables, by its
spelling.

Sampling: a sweep draws the tables of every dish of every restaurant, level by level, given
the other levels. Up to EXACT customers of a dish the number of tables is drawn at once from
its exact law, weight**t times the generalised Stirling number; a dish with more has as many
Gibbs steps as customers, each with a random customer who leaves a table and is seated again.
The weight of a new table is that of the sweep before, so dishes are drawn in parallel. The
table sizes of such large dishes are kept from sweep to sweep; in the spelling they start from
the mean path. After `burn_in` sweeps, the predictive probabilities of `sweeps` more are averaged.
Discounts come from the numbers of dishes with one and two customers, the strength is given.

Words of the corpus are counted in blocks of documents: a task keeps about `block_tokens`
tokens and stores each block's distinct words, their training counts and the documents as
numbers into that list. Counts are summed by word; a word's number is its place in that table.
A pair (previous word, word) is 64 bits of two such numbers. A block's pairs are dealt by their
hash into buckets, in which their counts are added up. A pair with one customer has one table
whatever is drawn, so only pairs seen twice or more become rows (previous, word, n, tables):
the tables of a restaurant are its customers less, for these rows, n - tables. Blocks get back
the words' and contexts' probabilities and only those pairs' counts that they cannot know. The
spelling model has at most 257**3 rows whatever the corpus, so it may be sent to every task.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorlens.llm.common import dropped, mix, shuffles_freed, stored, text_of

END = ""  # the end of a text, as a word: no word is empty
STOP = 256  # the end of a word, as a byte
SYMBOLS = 257
EXACT = 1000  # customers of a dish up to which its tables are drawn from their exact law


def held_out(key: str):
    """Documents that are scored only."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def tokens_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def blocks_of(df: DataFrame, key: str, text: str, block_tokens: int) -> DataFrame:
    """Rows (block, words, train, keys, held, sizes, tokens): `tokens` are 32-bit numbers into
    `words`, document after document, each with its end."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 24, 0
        index: dict[bytes, int] = {}
        parts, keys, held, total = [], [], [], 0

        def block() -> pd.DataFrame:
            train = np.zeros(len(index), np.int64)
            for ids, out in zip(parts, held, strict=True):
                if not out:
                    np.add.at(train, ids, 1)
            names = [w.decode("utf-8", "surrogatepass").encode("utf-8", "replace").decode() for w in index]
            row = (base + made, names, train, list(keys), list(held), [len(p) for p in parts], np.concatenate(parts).astype("<u4").tobytes())
            return pd.DataFrame([row], columns=["block", "words", "train", "keys", "held", "sizes", "tokens"])

        for frame in frames:
            for name, out, value in zip(frame["key"].array, frame["held"], frame["text"], strict=True):
                words = [*tokens_of(value), b""]
                parts.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
                keys.append(None if pd.isna(name) else name)
                held.append(bool(out))
                total += len(words)
                if total >= block_tokens:
                    yield block()
                    made += 1
                    index, parts, keys, held, total = {}, [], [], [], 0
        if parts:
            yield block()

    docs = df.select(F.col(key).alias("key"), held_out(key).alias("held"), text_of(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    schema = (
        f"block long, words array<string>, train array<bigint>, keys array<{kind}>, held array<boolean>, sizes array<int>, tokens binary"
    )
    return docs.mapInPandas(cut, schema)


def mean_tables(count: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Tables on the mean path: dk/dn = weight / (n - discount k + weight), in 16 growing steps."""
    k = np.ones(len(count))
    n = np.ones(len(count))
    for i in range(1, 17):
        to = np.maximum(count.astype(float) ** (i / 16), n)
        k += (to - n) * weight / (np.maximum(n - discount * k, 1e-9) + weight)
        n = to
    return np.clip(np.rint(k), 1, count).astype(np.int64)


def seated(count: np.ndarray, tables: np.ndarray) -> list[np.ndarray]:
    """Sizes for so many tables: one large, the others with one customer."""
    return [np.concatenate([[c - t + 1], np.ones(t - 1, np.int64)]) for c, t in zip(count.tolist(), tables.tolist(), strict=True)]


def reseated(sizes: list[np.ndarray], weight: np.ndarray, discount: float, steps: int | None, rng: np.random.Generator) -> list[np.ndarray]:
    """Gibbs steps for each dish (None: as many as it has customers): a customer drawn at random
    leaves and is seated at a table of size s with weight s - discount, or at a new one with `weight`."""
    return [np.array(_moved(s.tolist(), w, discount, steps, rng), np.int64) for s, w in zip(sizes, weight.tolist(), strict=True)]


def _moved(sizes: list[int], weight: float, discount: float, steps: int | None, rng: np.random.Generator) -> list[int]:
    """Steps in which a customer comes back to the first table are passed over at once: their
    number is geometric. `crowd` has the table of each customer of the other tables."""
    draw = random.Random(int(rng.integers(1 << 62))).random  # single numbers
    first, sizes = sizes[0], sizes[1:]
    crowd = [t for t, s in enumerate(sizes) for _ in range(s)]
    total, tables = first + len(crowd), len(sizes)
    left = total if steps is None else steps
    while True:
        back = first / total * (first - 1 - discount) / (total - 1 - discount * (tables + 1) + weight) if first > 1 else 0.0
        if 0 < back < 1:
            left -= int(math.log(1 - draw()) / math.log(back))
        left -= 1
        if left < 0 or back >= 1:
            return [s for s in (first, *sizes) if s]
        if not crowd or draw() * (1 - back) < first / total - back:
            first -= 1
            stays = 0.0  # coming back is not among the steps drawn here
        else:
            at = int(draw() * len(crowd))
            crowd[at], crowd[-1] = crowd[-1], crowd[at]
            old = crowd.pop()
            sizes[old] -= 1
            tables -= sizes[old] == 0
            stays = first - discount if first else 0.0
        others = len(crowd) - discount * tables if crowd else 0.0
        drawn = draw() * (weight + stays + others)
        if drawn < weight or stays + others <= 0:
            crowd.append(len(sizes))
            sizes.append(1)
            tables += 1
        elif drawn < weight + stays or not crowd:
            first += 1
        else:
            while True:  # by size, accepted with (size - discount) / size
                to = crowd[int(draw() * len(crowd))]
                if draw() * sizes[to] < sizes[to] - discount:
                    break
            sizes[to] += 1
            crowd.append(to)


@lru_cache(maxsize=4)
def stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: the seatings of c customers (row) at t
    tables (column), each with the product of what its customers found at their tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, EXACT):
        joined = np.log(c - discount * np.arange(1, c + 1)) + out[c, 1 : c + 1]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], np.append(joined, -np.inf))
    return out


def drawn_tables(count: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator, sizes=None) -> tuple[np.ndarray, list]:
    """Number of tables of each dish, and the sizes of those with more than EXACT customers
    (else None); `sizes` has theirs before, if there are any."""
    weight = np.maximum(weight, 1e-300)
    tables, kept = np.minimum(count, 1), [None] * len(count)
    law = stirling(discount)
    many = np.flatnonzero((count > 1) & (count <= EXACT))
    classes = np.ceil(np.log2(count[many]))  # dishes of like size at once
    for k in np.unique(classes).tolist():
        rows = many[classes == k]
        t = np.arange(1, count[rows].max() + 1)
        for part in np.array_split(rows, len(rows) * len(t) // 1_000_000 + 1):
            chance = law[:, 1 : len(t) + 1][count[part]] + np.log(weight[part])[:, None] * t
            chance = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            at = (chance < (rng.random(len(part)) * chance[:, -1])[:, None]).sum(axis=1)
            tables[part] = np.minimum(at + 1, count[part])
    rows = np.flatnonzero(count > EXACT)
    for i, k in zip(rows.tolist(), mean_tables(count[rows], weight[rows], discount), strict=True):
        old = None if sizes is None else sizes[i]
        old = seated(count[[i]], k[None])[0] if old is None or old.sum() != count[i] else old
        kept[i] = reseated([old], weight[[i]], discount, None, rng)[0]
        tables[i] = len(kept[i])
    return tables, kept


class Spelling:
    """Predictive probabilities of bytes after contexts of up to two bytes, and of words."""

    def __init__(self, levels: list[dict[str, np.ndarray]]):
        self.levels = levels  # by context length: keys and p of dishes, contexts and their backoff weight

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def after(self, context: np.ndarray, symbol: np.ndarray, length: int = 2) -> np.ndarray:
        """P(symbol | context): `context` holds two symbols, older * 257 + newer."""
        p = np.full(len(symbol), 1.0 / SYMBOLS)
        for k in range(length + 1):
            level = self.levels[k]
            ctx = context % SYMBOLS**k
            at, seen = self._find(level["keys"], ctx * SYMBOLS + symbol)
            where, known = self._find(level["contexts"], ctx)
            backoff = np.where(known, level["backoff"][where] if len(level["contexts"]) else 1.0, 1.0)
            own = np.where(seen, level["own"][at] if len(level["keys"]) else 0.0, 0.0)
            p = np.where(known, own, 0.0) + backoff * p
        return p

    def words(self, words: list[bytes]) -> np.ndarray:
        """Logarithm of the probability of each word's bytes and its end."""
        if not words:
            return np.zeros(0)
        context, symbol, ends = grams(words)
        logs = np.log(self.after(context, symbol))
        return np.add.reduceat(logs, np.concatenate([[0], ends[:-1]]))


UNIFORM = Spelling([{"keys": np.zeros(0, np.int64), "own": np.zeros(0), "contexts": np.zeros(0, np.int64), "backoff": np.zeros(0)}] * 3)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and symbols of all words, one after another, and where each word ends. The
    symbol before a word is the end of the one before it."""
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes)
    symbol = np.full(int(ends[-1]), STOP, np.int64)
    inside = np.ones(len(symbol), bool)
    inside[ends - 1] = False
    symbol[inside] = np.frombuffer(b"".join(words), np.uint8)
    starts = ends - sizes
    one = np.concatenate([[STOP], symbol[:-1]])
    two = np.concatenate([[STOP, STOP], symbol[:-2]])[: len(symbol)]
    two[starts] = STOP
    return two * SYMBOLS + one, symbol, ends


def gram_counts(words: DataFrame) -> DataFrame:
    """Rows (context, symbol, n) of the words' tables; a task sums its own first."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            names = [w.encode("utf-8", "surrogatepass") for w in frame["word"]]
            context, symbol, ends = grams(names)
            tables = frame["tables"].to_numpy()
            each = np.repeat(tables, np.diff(np.concatenate([[0], ends])))
            keys, where = np.unique(np.concatenate([keys, context * SYMBOLS + symbol]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([sums, each]), minlength=len(keys)).astype(np.int64)
        if len(keys):
            yield pd.DataFrame({"context": keys // SYMBOLS, "symbol": keys % SYMBOLS, "n": sums})

    parts = words.where("tables > 0").select("word", "tables")
    return parts.mapInPandas(count, "context long, symbol long, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def spelled(counts: DataFrame, before: Spelling | None, discount: float, strength: float) -> Spelling:
    """Seat the spelling's customers from long contexts to short ones and take the predictive
    probabilities. A group is one context: 257 dishes at most."""
    levels: list[dict] = [{}, {}, {}]
    rows = counts
    for k in (2, 1, 0):

        def seat(frame: pd.DataFrame) -> pd.DataFrame:
            context, symbol, n = (frame[c].to_numpy() for c in ("context", "symbol", "n"))
            rng = np.random.default_rng(int(context[0]) * 3 + k)
            if before is not None and k:
                parent = before.after(context, symbol, k - 1)
            else:
                parent = np.full(len(symbol), 1.0 / SYMBOLS)
            total = float(len(n))
            for _ in range(2):  # the number of tables and its effect on new ones settle together
                tables = mean_tables(n, (strength + discount * total) * parent, discount)
                total = float(tables.sum())
            tables, _ = drawn_tables(n, (strength + discount * total) * parent, discount, rng)
            return pd.DataFrame({"context": context, "symbol": symbol, "n": n, "tables": tables})

        dealt = rows.repartition(32, "context") if k == 2 else rows
        done = stored(dealt.groupBy("context").applyInPandas(seat, "context long, symbol long, n long, tables long"), "spelling")
        got = done.toPandas()  # at most 257**3 rows
        sums = got.groupby("context")[["n", "tables"]].sum().sort_index()
        keys = (got["context"] * SYMBOLS + got["symbol"]).to_numpy()
        order = np.argsort(keys)
        whole = strength + got["context"].map(sums["n"]).to_numpy()
        levels[k] = {
            "keys": keys[order],
            "own": ((got["n"] - discount * got["tables"]).to_numpy() / whole)[order],
            "contexts": sums.index.to_numpy(),
            "backoff": ((strength + discount * sums["tables"]) / (strength + sums["n"])).to_numpy(),
        }
        rows = done.groupBy(F.pmod("context", F.lit(SYMBOLS ** (k - 1) if k else 1)).alias("context"), "symbol").agg(F.sum("tables").alias("n"))
    return Spelling(levels)


def pairs_of(ident: np.ndarray, sizes: np.ndarray, held: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
    """A block's distinct pairs (previous word << 32 | word), sorted; a place in the block with
    each, the pair at each place, training customers of each, and the previous words' numbers."""
    previous = np.concatenate([tokens[:1], tokens[:-1]])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    previous[starts] = tokens[sizes[0] - 1]  # a text starts where one ends
    keys, first, pair = np.unique((ident[previous] << np.uint64(32)) | ident[tokens], return_index=True, return_inverse=True)
    count = np.bincount(pair, np.repeat(~held, sizes), len(keys)).astype(np.int64)
    return keys, first, pair, count, previous


def in_buckets(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of a block's sorted pairs by bucket."""
    own = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    values, starts = np.unique(own[order], return_index=True)
    yield from zip(values.tolist(), np.split(order, starts[1:]), strict=True)


def block_arrays(row: pd.Series) -> tuple[np.ndarray, ...]:
    """(ident, n, sizes, held, tokens): the words' numbers and training counts by their place
    in the block's list, and its documents."""
    ident, n = np.zeros(len(row["at"]), np.uint64), np.zeros(len(row["at"]))
    ident[row["at"]], n[row["at"]] = row["id"], row["n"]
    return ident, n, np.asarray(row["sizes"], np.int64), np.asarray(row["held"], bool), np.frombuffer(row["tokens"], "<u4").astype(np.int64)


def pair_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, block, first, second, once, twice). Block -1 has a bucket's pairs seen twice
    or more in training: pairs and customers. Other rows say what a block is to be told: places
    among its pairs of this bucket and among those of block -1 (-1: a pair seen once, elsewhere)."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                keys, _, _, count, _ = pairs_of(*(block_arrays(row)[i] for i in (0, 2, 3, 4)))
                out = [(b, row["block"], keys[x].tobytes(), count[x].astype("<u4").tobytes()) for b, x in in_buckets(keys, buckets)]
                yield pd.DataFrame(out, columns=["bucket", "block", "keys", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, "<u8") for x in frame["keys"]]
        own = np.concatenate([np.frombuffer(x, "<u4") for x in frame["counts"]])
        keys, pair = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(pair, own).astype(np.int64)
        many = total > 1
        place = np.where(many, np.cumsum(many) - 1, -1).astype("<i4")
        out = [(-1, keys[many].tobytes(), total[many].tobytes(), int((total == 1).sum()), int((total == 2).sum()))]
        ends = np.cumsum([len(x) for x in lists])
        for block, start, end in zip(frame["block"].tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            here = pair[start:end]
            at = np.flatnonzero(many[here] | ((own[start:end] == 0) & (total[here] == 1)))
            out.append((block, at.astype("<u4").tobytes(), place[here[at]].tobytes(), 0, 0))
        made = pd.DataFrame(out, columns=["block", "first", "second", "once", "twice"])
        return made.assign(bucket=frame["bucket"].iloc[0])

    dealt = blocks.select("block", "sizes", "held", "tokens", "at", "id", "n").mapInPandas(deal, "bucket int, block long, keys binary, counts binary")
    return dealt.groupBy("bucket").applyInPandas(add, "block long, first binary, second binary, once long, twice long, bucket int")


def repeated_pairs(pairs: DataFrame) -> DataFrame:
    """Rows (bucket, place, previous, next, n, tables, total, sizes), a table for each pair."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket, keys, n in zip(frame["bucket"].tolist(), frame["first"], frame["second"], strict=True):
                keys, n = np.frombuffer(keys, "<u8"), np.frombuffer(n, "<i8")
                for start in range(0, len(keys), 100_000):
                    x = keys[start : start + 100_000]
                    ends = {"previous": (x >> np.uint64(32)).astype(np.int64), "next": (x & np.uint64(0xFFFFFFFF)).astype(np.int64)}
                    yield pd.DataFrame({"bucket": bucket, "place": np.arange(start, start + len(x)), **ends, "n": n[start : start + len(x)]})

    made = pairs.where("block < 0").select("bucket", "first", "second").mapInPandas(rows, "bucket int, place int, previous long, next long, n long")
    return made.select("*", F.lit(1).cast("long").alias("tables"), F.lit(0).cast("long").alias("total"), F.lit(None).cast("array<bigint>").alias("sizes"))


def with_customers(words: DataFrame, seats: DataFrame) -> DataFrame:
    """`words` with `customers`, the tables at which a word is served, and `opened`, the tables
    of the restaurant of which it is the context: its n less n - tables of the repeated pairs."""
    out = words
    for side, name in (("next", "customers"), ("previous", "opened")):
        lost = seats.groupBy(F.col(side).alias("id")).agg(F.sum(F.col("n") - F.col("tables")).alias("lost"))
        out = out.join(lost, "id", "left").withColumn(name, F.col("n") - F.coalesce("lost", F.lit(0))).drop("lost")
    return out


def pair_seats(seats: DataFrame, words: DataFrame, discount: float, strength: float, counted: bool, sweep: int) -> DataFrame:
    """A sweep of the repeated pairs' dishes; `words` has `chance`, the log of a word's probability."""

    def sit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rng = np.random.default_rng([sweep, *frame[["bucket", "place"]].iloc[0].tolist(), TaskContext.get().partitionId()])
            weight = (strength + discount * frame["opened"].to_numpy()) * np.exp(frame["chance"].to_numpy())
            tables, sizes = drawn_tables(frame["n"].to_numpy(), weight, discount, rng, frame["sizes"].tolist())
            total = frame["total"] + tables * counted
            yield frame.drop(columns=["opened", "chance"]).assign(tables=tables, total=total, sizes=pd.Series(sizes, dtype=object, index=frame.index))

    both = seats.join(words.select(F.col("id").alias("next"), "chance"), "next").join(words.select(F.col("id").alias("previous"), "opened"), "previous")
    return both.select(*seats.columns, "opened", "chance").mapInPandas(sit, seats.schema)


def word_seats(words: DataFrame, spelling: Spelling, opened: float, discount: float, strength: float, sweep: int) -> DataFrame:
    """A sweep of the word restaurant; `spelled` is the log of a word's spelling."""
    law = words.sparkSession.sparkContext.broadcast(spelling.levels)  # at most 257**3 rows

    def sit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = [w.encode("utf-8", "surrogatepass") for w in frame["word"]]
            logs = Spelling(law.value).words(names)
            rng = np.random.default_rng(xxhash.xxh3_64_intdigest(names[0]) + sweep if names else 0)
            tables, sizes = drawn_tables(frame["customers"].to_numpy(), (strength + discount * opened) * np.exp(logs), discount, rng, frame["sizes"].tolist())
            yield frame.assign(tables=tables, spelled=logs, sizes=pd.Series(sizes, dtype=object, index=frame.index))

    return words.mapInPandas(sit, words.schema)


def with_chance(words: DataFrame, discount: float, strength: float) -> DataFrame:
    """`chance`: log of a word's probability in the word restaurant."""
    customers, opened = (float(x or 0) for x in words.agg(F.sum("customers"), F.sum("tables")).first())
    whole = customers + strength
    new = (strength + discount * opened) / whole
    own = (F.col("customers") - discount * F.col("tables")) / whole
    known = F.log(own + new * F.exp("spelled"))
    return words.withColumn("chance", F.when(F.col("customers") > 0, known).otherwise(math.log(new) + F.col("spelled")))


def word_answers(blocks: DataFrame, words: DataFrame, names: list[str], span: int = 200_000) -> DataFrame:
    """Rows (block, paired, bucket, at, values): `names` of a block's words in the order of their
    numbers, `span` numbers a bucket."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, ids in zip(frame["block"].tolist(), frame["id"], strict=True):
                ids = np.sort(ids)
                values, starts = np.unique(ids // span, return_index=True)
                parts = zip(values.tolist(), np.split(ids, starts[1:]), strict=True)
                yield pd.DataFrame([(b, block, (x - b * span).astype("<u4").tobytes()) for b, x in parts], columns=["bucket", "block", "ids"])

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((span, len(names)), "<f4")
        table[known["id"].to_numpy() % span] = known[names].to_numpy()
        out = [(block, False, bucket, b"", table[np.frombuffer(ids, "<u4")].tobytes()) for bucket, block, ids in asked[["bucket", "block", "ids"]].itertuples(index=False)]
        return pd.DataFrame(out, columns=["block", "paired", "bucket", "at", "values"])

    asked = blocks.select("block", "id").mapInPandas(ask, "bucket long, block long, ids binary")
    known = words.select(F.floor(F.col("id") / span).cast("long").alias("bucket"), "id", *names)
    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(answer, ANSWER)


def pair_answers(pairs: DataFrame, seats: DataFrame, discount: float, samples: int) -> DataFrame:
    """Rows (block, paired, bucket, at, values): customers less discounts of the pairs asked for."""

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(len(known), "<f4")
        table[known["place"].to_numpy()] = known["own"].to_numpy()
        table = np.append(table, np.float32(1 - discount))  # the last one is for pairs seen once
        rows = asked[["block", "bucket", "first", "second"]].itertuples(index=False)
        out = [(block, True, bucket, at, table[np.frombuffer(place, "<i4")].tobytes()) for block, bucket, at, place in rows]
        return pd.DataFrame(out, columns=["block", "paired", "bucket", "at", "values"])

    asked = pairs.where("block >= 0").select(F.col("bucket").cast("long").alias("bucket"), "block", "first", "second")
    known = seats.select(F.col("bucket").cast("long").alias("bucket"), "place", (F.col("n") - discount * F.col("total") / samples).alias("own"))
    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(answer, ANSWER)


ANSWER = "block long, paired boolean, bucket long, at binary, values binary"


def scored(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sweeps: int = 2,
    burn_in: int = 1,
    strength: float = 1.0,
    spelling_discount: float = 0.5,
    block_tokens: int = 1_000_000,
    bucket_tokens: int = 3_000_000,
) -> DataFrame:
    """One row for each row of `df`: key, held_out, n_tokens, n_known, train_tokens, base_score,
    score and perplexity (10 to the minus mean score of a token).

    A null or empty text has its end alone. Null keys count as the empty text for the choice
    of training documents; repeated rows are documents of their own; an empty table gives an
    empty result. Without training tokens a word has the uniform law of its bytes.
    """
    with shuffles_freed(df.sparkSession):
        return _scored(df, key, text, max(sweeps, 1), burn_in, strength, spelling_discount, block_tokens, bucket_tokens)


def estimated(once: int | None, twice: int | None) -> float:
    """A discount from the numbers of dishes with one and with two customers."""
    return min(max(once / (once + 2 * (twice or 0)), 0.05), 0.95) if once else 0.5


def _scored(df, key, text, sweeps, burn_in, strength, spelling_discount, block_tokens, bucket_tokens) -> DataFrame:
    blocks = stored(blocks_of(df, key, text, block_tokens), "blocks")
    each = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("at", "x")).select("block", "at", "x.words", "x.train")
    words = each.groupBy(F.col("words").alias("word")).agg(F.sum("train").alias("n"))
    words = stored(words.withColumn("mark", F.monotonically_increasing_id()), "words")
    parts = {r["part"]: r["rows"] for r in words.groupBy(F.shiftright("mark", 33).alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    before = np.cumsum([0, *(parts.get(i, 0) for i in range(max(parts, default=0) + 1))]).tolist()
    if before[-1] >> 32:
        raise ValueError("a word's number has 32 bits")
    number = F.element_at(F.lit(before), F.shiftright("mark", 33).cast("int") + 1) + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    words = words.select(number.cast("long").alias("id"), "word", "n")
    train, kinds = (int(x or 0) for x in words.where("n > 0").agg(F.sum("n"), F.count(F.lit(1))).first())

    lists = [F.collect_list(c).alias(c) for c in ("at", "id", "n")]  # lists of plain numbers take half of what structs take
    matched = each.drop("train").join(words.withColumnRenamed("word", "words"), "words").groupBy("block").agg(*lists)
    documents = blocks.select("block", "keys", "held", "sizes", "tokens")
    numbered = stored(documents.join(matched, "block"), "numbered")
    dropped(blocks)
    tokens = numbered.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    pairs = stored(pair_counts(numbered, -(-tokens // bucket_tokens) or 1), "pairs")
    discount = estimated(*pairs.agg(F.sum("once"), F.sum("twice")).first())
    seats = stored(repeated_pairs(pairs), "pair-seats")

    first = [(F.col("n") > 0).cast("long").alias("tables"), F.lit(0.0).alias("spelled"), F.lit(None).cast("array<bigint>").alias("sizes")]
    state = stored(with_customers(words, seats).select("*", *first), "words")
    ones = [F.sum((F.col("customers") == i).cast("int")) for i in (1, 2)]
    word_discount = estimated(*state.agg(*ones).first())
    spelling, opened, names = None, float(kinds), []
    for sweep in range(burn_in + sweeps + 1):
        if sweep:  # before the first sweep, the words' law comes from a table a pair
            old = seats
            seats = stored(pair_seats(seats, state, discount, strength, sweep > burn_in, sweep), "pair-seats")
            dropped(old)
            state = with_customers(state.drop("customers", "opened", "chance"), seats).select(*state.drop("chance").columns)
        spelling = spelled(gram_counts(state), spelling, spelling_discount, strength) if train else UNIFORM
        state = stored(word_seats(state, spelling, opened, word_discount, strength, sweep), "words")
        opened = float(state.agg(F.sum("tables")).first()[0] or 0)
        state = with_chance(state, word_discount, strength)
        if sweep > burn_in:
            ends = {f"p{sweep}": F.col("chance") / math.log(10), f"b{sweep}": F.log10((strength + discount * F.col("opened")) / (strength + F.col("n")))}
            names += ends
            state = state.select("*", *(v.cast("float").alias(k) for k, v in ends.items()))

    answers = word_answers(numbered, state, names).unionByName(pair_answers(pairs, seats, discount, sweeps))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("paired", "bucket", "at", "values")).alias("answers"))
    buckets = -(-tokens // bucket_tokens) or 1
    kind = df.schema[key].dataType
    row = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.log10(train + kinds + 1.0)
        for frame in frames:
            for _, block in frame.iterrows():
                ident, n, sizes, held, tokens = block_arrays(block)
                keys, first, pair, count, previous = pairs_of(ident, sizes, held, tokens)
                told = {(x["paired"], x["bucket"]): x for x in block["answers"]}
                law = [np.frombuffer(told[x]["values"], "<f4").reshape(-1, len(names)) for x in sorted(told) if not x[0]]
                laws = np.zeros((len(ident), len(names)))
                laws[np.argsort(ident)] = np.concatenate(law)
                own = np.where(count == 1, 1 - discount, 0.0)  # what is not told: seen here once or nowhere
                for bucket, places in in_buckets(keys, buckets):
                    x = told[True, bucket]
                    own[places[np.frombuffer(x["at"], "<u4")]] = np.frombuffer(x["values"], "<f4")
                left, right = previous[first], tokens[first]
                back = laws[right][:, ::2] + laws[left][:, 1::2]
                most = back.max(axis=1)
                back = most + np.log10(np.mean(10.0 ** (back - most[:, None]), axis=1))
                with np.errstate(divide="ignore"):
                    own = np.log10(own / (strength + n[left]))
                most = np.maximum(own, back)
                logs = most + np.log10(10.0 ** (own - most) + 10.0 ** (back - most))
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                yield pd.DataFrame(
                    {
                        "key": block["keys"],
                        "held_out": held,
                        "n_tokens": sizes,
                        "n_known": np.add.reduceat((n > 0)[tokens].astype(np.int64), starts),
                        "base_score": np.add.reduceat((np.log10(n + 1) - whole)[tokens], starts),
                        "score": np.add.reduceat(logs[pair], starts),
                    }
                )

    out = numbered.join(answers, "block").mapInPandas(score, row)
    return out.select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def score_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.withColumnRenamed(key, "doc_id")
