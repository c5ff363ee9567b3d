"""Removal of repeated passages by paragraph MinHash banding.

A paragraph is a run of words of the whole text, cut where the hash of two neighbouring words
is the least within `reach` words to either side. Cuts follow from the words alone, so a
passage is cut alike wherever it stands: in a line of its own, inside a longer line, or over
many short lines. Paragraphs of equal words are one class; each class has a MinHash signature
of its five-word shingles, cut into bands that are tuned for the recall. Classes that collide
in a band are joined, compared exactly (Jaccard, in blocks), and the components of the
verified links are the groups. A group counts if two rows or more hold it. Neighbouring
repeated paragraphs of `least_words` words or more together are a repeated passage; in each,
the first paragraph of a group, by document key and place, stays and the others are removed.

A passage's first and last words, up to its outermost cuts, are not part of the span found.

Exact passages: a run of `WINDOW + SPREAD - 1` words or more that two rows share is found
whether or not a whole paragraph lies in it. Of every SPREAD neighbouring windows of WINDOW
words the one with the least hash is chosen, so rows that share the run choose a window of it
alike. A task sends the distinct windows of its texts as arrays, by range of their hash, and is
told which of them another row holds; overlapping ones are one passage. It makes a passage of
the repeated paragraphs that it meets, however short they are, or else of itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.common import WordHashes, dropped, fresh, mix, shingle_hashes, shuffles_freed, stored, text_of, word_places, words_of
from floorlens.llm.similar import SHINGLE, components, forest, in_blocks, in_tasks, jaccard_blocks, seeds, signatures

_MOST = np.uint64(2**64 - 1)
_BASE = 0x9E3779B97F4A7C15
BUCKET = 20_000_000  # characters of text whose windows are compared in one task
WINDOW, SPREAD = 42, 10  # any 51 words hold SPREAD windows of WINDOW words


def tuned_bands(threshold: float, recall: float, most_values: int) -> tuple[int, int]:
    """The longest bands (fewest false collisions) that reach the recall with so many values."""
    for rows in range(12, 1, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_values:
            return bands, rows
    return most_values, 1


def extremes(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least (or greatest, by `pick`) of each run of `size` neighbours."""
    have = 1
    while have < size:  # of 2, 4, 8, ... neighbours, then of `size`
        step = min(have, size - have)
        values = pick(values[: len(values) - step], values[step:])
        have += step
    return values


def cuts(hashes: np.ndarray, reach: int) -> list[int]:
    """First word of each paragraph, and the number of words: where the hash of two words is
    the least of those up to `reach` before and after it. Of equal least ones, as in a text
    that repeats a few words, those more than `reach` apart are taken."""
    n = len(hashes) - 1
    found = [0]
    if n > 0:
        pairs = shingle_hashes(hashes, 2)
        edge = np.full(reach, _MOST, np.uint64)
        lows = extremes(np.concatenate([edge, pairs, edge]), reach, np.minimum)
        least = (pairs <= lows[:n]) & (pairs <= lows[reach + 1 : reach + 1 + n])
        for at in np.flatnonzero(least).tolist():
            if at - found[-1] > reach or (at and len(found) == 1):
                found.append(at)
    return [*found, len(hashes)]


def paragraphs(text: str, reach: int, hashes: WordHashes, width: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, word hashes, shingle hashes) of the paragraphs; code points, end exclusive."""
    words, starts, ends = word_places(text)
    yield from _cut_up(hashes.of(words), starts, ends, reach, width)


def _cut_up(own: np.ndarray, starts: np.ndarray, ends: np.ndarray, reach: int, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    if len(own):
        bounds = cuts(own, reach)
        shingles = shingle_hashes(own, width)
        for a, b in zip(bounds, bounds[1:], strict=False):
            inside = shingles[a : b - width + 1] if b - a >= width else shingle_hashes(own[a:b], width)
            yield int(starts[a]), int(ends[b - 1]), own[a:b], inside


def chosen_windows(texts: list[np.ndarray], width: int = WINDOW, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of `width` words of some texts' word hashes: those with the least hash of any
    `spread` neighbours. Returns the text, the first word (counted over all texts) and the hash."""
    sizes = np.array([len(x) for x in texts], np.int64)
    n, whole = int(sizes.sum()), width + spread - 1
    if n < whole:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.concatenate(texts)
    powers, inverse = (np.cumprod(np.full(n, x, np.uint64)) for x in (_BASE, pow(_BASE, -1, 2**64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    values = mix((sums[width:] - sums[:-width]) * inverse[: n - width + 1])
    ends = np.repeat(np.cumsum(sizes), sizes)
    lows = extremes(values, spread, np.minimum)
    lows[np.arange(len(lows)) + whole > ends[: len(lows)]] = 0  # these reach into the next text
    edge = np.zeros(spread - 1, np.uint64)
    at = np.flatnonzero((values == extremes(np.concatenate([edge, lows, edge]), spread, np.maximum)) & (values > 0))
    return np.repeat(np.arange(len(texts)), sizes)[at], at, values[at]


class _Batch:
    """The chosen windows of some texts of a task, to be compared with those of the others."""

    MOST = 400_000

    def __init__(self, buckets: int):
        self.edges = np.array([(2**64 * b) // buckets for b in range(1, buckets)], np.uint64)
        self.made, self.parts, self.size = TaskContext.get().partitionId() << 24, [], 0

    def add(self, rows: list, texts: list[np.ndarray], starts: list[np.ndarray], ends: list[np.ndarray]) -> None:
        text, first, values = chosen_windows(texts)
        if len(values):
            start = np.concatenate(starts)[first]
            self.parts.append((np.array(rows, np.int64)[text], start, np.concatenate(ends)[first + WINDOW - 1] - start, values))
            self.size += len(values)

    def full(self) -> bool:
        return self.size >= self.MOST

    def frame(self) -> pd.DataFrame:
        """A row for each bucket, and one (bucket -1) that says where the windows are."""
        rows, start, length, values = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        keys, first, which = np.unique(values, return_index=True, return_inverse=True)
        last = np.zeros(len(keys), np.int64)
        last[which] = np.arange(len(which))
        several = rows[first] != rows[last]
        bounds = [0, *np.searchsorted(keys, self.edges).tolist(), len(keys)]
        out = [(b, x, keys[x:y].astype("<u8").tobytes(), several[x:y].tobytes()) for b, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)) if x < y]
        out.append((-1, 0, rows.astype("<i8").tobytes(), np.concatenate([start, length, which]).astype("<u4").tobytes()))
        made = pd.DataFrame(out, columns=["bucket", "place", "keys", "several"]).assign(batch=self.made)
        self.made, self.parts, self.size = self.made + 1, [], 0
        return made


def signed(rows: DataFrame, reach: int, width: int, values: int, seed: int, buckets: int) -> DataFrame:
    """Rows (row, key, place, start, end, words, node, signature) from (row, key, text), and,
    with a batch, those of its windows (batch, bucket, place of the first in the batch, keys, several)."""
    multipliers = seeds(values, seed)
    kind = rows.schema["key"].dataType.simpleString()
    names = ["row", "key", "place", "start", "end", "words", "node", "signature", "batch", "bucket", "keys", "several"]

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, batch = WordHashes(), _Batch(buckets)
        for frame in frames:
            for first in range(0, len(frame), 200):  # some hundred texts at a time
                part = frame.iloc[first : first + 200]
                out, sets, places = [], [], []
                for row, key, text in zip(part["row"], part["key"], part["text"], strict=True):
                    words, starts, ends = word_places(text)
                    own = hashes.of(words)
                    places.append((own, starts, ends))
                    for place, (start, end, inside, shingles) in enumerate(_cut_up(own, starts, ends, reach, width)):
                        sets.append(shingles)
                        out.append((row, key, place, start, end, len(inside), xxhash.xxh3_128_digest(inside.tobytes())))
                batch.add(part["row"].tolist(), *(list(x) for x in zip(*places, strict=True)))
                made = pd.DataFrame(out, columns=names[:7])
                made["key"] = made["key"].astype(part["key"].dtype)
                made["signature"] = [x.tobytes() for x in signatures(sets, multipliers).astype("<u8")] if sets else []
                yield made.reindex(columns=names)
                if batch.full():
                    yield batch.frame().reindex(columns=names)
        if batch.size:
            yield batch.frame().reindex(columns=names)

    schema = f"row long, key {kind}, place int, start int, end int, words int, node binary, signature binary, batch long, bucket int, keys binary, several binary"
    return rows.mapInPandas(sign, schema)


def shared_passages(marks: DataFrame) -> DataFrame:
    """Rows (row, start, end, windows): overlapping chosen windows that another row holds too."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, "<u8") for x in frame["keys"]]
        keys, which, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        several = np.concatenate([np.frombuffer(x, bool) for x in frame["several"]])
        held = ((count > 1) | (np.bincount(which, several, len(keys)) > 0))[which]
        out, at = [], 0
        for batch, place, own in zip(frame["batch"].tolist(), frame["place"].tolist(), lists, strict=True):
            found = np.flatnonzero(held[at : at + len(own)])
            at += len(own)
            if len(found):
                out.append((batch, (found + place).astype("<u4").tobytes(), own[found].tobytes()))
        return pd.DataFrame(out, columns=["batch", "at", "keys"])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, places, held in zip(frame["rows"], frame["places"], frame["held"], strict=True):
                rows = np.frombuffer(rows, "<i8")
                start, length, which = np.frombuffer(places, "<u4").astype(np.int64).reshape(3, len(rows))
                at = np.concatenate([np.frombuffer(x["at"], "<u4") for x in held])
                known, keys = np.zeros(int(which.max()) + 1, bool), np.zeros(int(which.max()) + 1, np.uint64)
                known[at], keys[at] = True, np.concatenate([np.frombuffer(x["keys"], "<u8") for x in held])
                here = np.flatnonzero(known[which])
                row, low, high, own = rows[here], start[here], (start + length)[here], keys[which[here]].view(np.int64)
                begins = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (low[1:] > high[:-1])]))
                last = np.concatenate([begins[1:], [len(here)]]) - 1
                windows = [x.tolist() for x in np.split(own, begins[1:])]
                yield pd.DataFrame({"row": row[begins], "start": low[begins], "end": high[last], "windows": windows})

    asked = marks.where("bucket >= 0").select("bucket", "batch", "place", "keys", "several")
    told = asked.groupBy("bucket").applyInPandas(compare, "batch long, at binary, keys binary")
    told = told.groupBy("batch").agg(F.collect_list(F.struct("at", "keys")).alias("held"))
    own = marks.where("bucket < 0").select("batch", F.col("keys").alias("rows"), F.col("several").alias("places"))
    return own.join(told, "batch").mapInPandas(place, "row long, start int, end int, windows array<bigint>")


def shingle_sets(texts: list[str], hashes: WordHashes, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, worked out over all of them at once."""
    own = [hashes.of(words_of(t)) for t in texts]
    whole = shingle_hashes(np.concatenate(own), width) if own else np.zeros(0, np.uint64)
    at = 0
    for x in own:
        yield np.unique(whole[at : at + len(x) - width + 1] if len(x) >= width else shingle_hashes(x, width))
        at += len(x)


def shingles_of(numbered: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """Rows (node, shingles) of the paragraphs `chosen` (node, row, start, end): the shingles'
    hashes, sorted and distinct; whole texts travel compressed."""

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=3)
        return pd.Series([pack.compress(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=object)

    def cut_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        for frame in frames:
            nodes, texts = [], []
            for data, wanted in zip(frame["packed"], frame["wanted"], strict=True):
                text = unpack.decompress(data).decode("utf-8", "surrogatepass")
                nodes += [x["node"] for x in wanted]
                texts += [text[x["start"] : x["end"]] for x in wanted]
            sets = list(shingle_sets(texts, hashes, width))
            yield pd.DataFrame({"node": nodes, "shingles": [x.astype("<u8").tobytes() for x in sets]})

    wanted = chosen.groupBy("row").agg(F.collect_list(F.struct("node", "start", "end")).alias("wanted"))  # of one text
    own = numbered.select("row", packed("text").alias("packed")).join(wanted, "row")
    return own.select("packed", "wanted").mapInPandas(cut_up, "node string, shingles binary")


def few_links(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """What `jaccard_blocks` gives, pair by pair: quicker for a few sets."""
    sets, others = [set(x.tolist()) for x in left], [set(x.tolist()) for x in right]
    links = np.zeros((len(left), len(right)), bool)
    for i, x in enumerate(sets):
        for j, y in enumerate(others):
            shared = len(x & y)
            links[i, j] = shared >= threshold * (len(x) + len(y) - shared) - 1e-9
    return links


def prefix_parts(members: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Rows (group, part, id) for members (group, id, node): a part is a shingle that is among the rarest of its
    member in the group, as many as a set may lack and still have `threshold` with another one, and one more.

    Two sets with that similarity have one of these in common, whatever else they hold, so pairs that share no part need no comparison.
    """

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [np.frombuffer(x, "<i8") for x in frame["shingles"]]
            if sets:
                sizes = np.array([len(x) for x in sets])
                some = sizes - np.ceil(threshold * sizes - 1e-6).astype(np.int64) + 1
                own = {"group": frame["group"], "id": frame["id"], "some": some}
                yield pd.DataFrame({**{k: np.repeat(np.asarray(v), sizes) for k, v in own.items()}, "part": np.concatenate(sets)})

    sets = members.join(shingles.select("node", "shingles"), "node").select("group", "id", "shingles")
    parts = sets.mapInPandas(spread, "group long, id long, some long, part long")
    parts = parts.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("group", "part")))
    rarest = F.row_number().over(Window.partitionBy("group", "id").orderBy("held", "part"))
    return parts.withColumn("rarest", rarest).where("rarest <= some AND held > 1").select("group", "part", "id")


def compared(groups: DataFrame, shingles: DataFrame, threshold: float, block: int) -> DataFrame:
    """Rows (group, id) whose pairs within a group are to be compared: those of `groups` (group, node), but a group of
    more than `block`, as a common phrase makes it, in its parts where these have fewer pairs. No pair of the threshold is lost."""
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    known = groups.select("group", F.xxhash64("node").alias("id"), "node").join(sizes, "group")
    large = known.where(F.col("n") > block)
    parts = stored(prefix_parts(large, shingles, threshold), "parts")
    pairs = parts.groupBy("group", "part").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = pairs.groupBy("group").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    large = large.select("group", "n").distinct().join(pairs, "group", "left")
    cheaper = stored(large.where(F.coalesce("pairs", F.lit(0.0)) < F.col("n") * F.col("n").cast("double")).select("group"), "cheaper")
    whole = known.join(cheaper, "group", "left_anti").select("group", "id")
    return whole.unionByName(parts.join(cheaper, "group").select(F.xxhash64("group", "part").alias("group"), "id"))


#: Links of two blocks that are told as they are, before a look at what each block links by itself.
_FEW = 16


def paragraph_links(groups: DataFrame, shingles: DataFrame, threshold: float, block: int) -> DataFrame:
    """Exact Jaccard within each of `groups` (group, node): rows (node, other) that span the links of all its pairs.

    A block's own task tells what is linked within it, so two blocks add only what joins parts of them that are not
    linked yet: copies that are all alike give about a row each, however large their group is.
    """

    def work(alone: bool, left: list, right: list) -> list[tuple]:
        sets = [np.frombuffer(x, "<u8") for x in left[1]]
        others = sets if alone else [np.frombuffer(x, "<u8") for x in right[1]]
        compare = few_links if len(sets) * len(others) <= 64 else jaccard_blocks
        links = compare(sets, others, threshold)
        if alone:
            return forest(np.triu(links, 1), left[0], left[0])
        found = forest(links, left[0], right[0])
        if len(found) > _FEW:
            within = [forest(np.triu(jaccard_blocks(x, x, threshold), 1), y, y) for x, y in ((sets, left[0]), (others, right[0]))]
            found = forest(links, left[0], right[0], [*within[0], *within[1]])
        return found

    members = compared(groups, shingles, threshold, block)
    tasks = in_blocks(members, shingles.select(F.xxhash64("node").alias("id"), "node", "shingles"), block)
    return in_tasks(tasks, ["node", "shingles"], work, "node string, other string")


def colliding(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """Rows (group, node) of the classes that share a band with another class."""
    band = [F.xxhash64(F.lit(i), F.substring("signature", 8 * rows * i + 1, 8 * rows)) for i in range(bands)]
    members = classes.select(F.explode(F.array(*band)).alias("group"), "node")
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    return members.join(sizes, "group")


def verified_groups(classes: DataFrame, numbered: DataFrame, bands: int, rows: int, threshold: float, width: int, block: int) -> DataFrame:
    """Rows (node, component, first, low, high) of the classes that several rows hold or
    that are linked with another class; the stored `classes` are removed."""
    likely = stored(colliding(classes, bands, rows).select("group", F.hex("node").alias("node")), "colliding")
    near = likely.select(F.unhex("node").alias("node")).distinct().withColumn("near", F.lit(True))
    known = classes.select("node", "first", "low", "high").join(near, "node", "left")
    known = stored(known.where("near OR low < high"), "known")
    dropped(classes)
    chosen = known.where("near").select(
        F.hex("node").alias("node"), F.col("first.row").alias("row"), F.col("first.start").alias("start"), F.col("first.end").alias("end")
    )
    # pairs of one band only: components of mere collisions would chain unrelated paragraphs together
    shingles = stored(shingles_of(numbered, chosen, width), "shingles")
    links = stored(paragraph_links(likely, shingles, threshold, block), "links")
    dropped(shingles)
    dropped(likely)
    groups = components(links.select("node", "other")).withColumnRenamed("component", "own")
    named = known.drop("near").withColumn("node", F.hex("node")).join(groups, "node", "left")
    return named.withColumn("component", F.coalesce("own", "node")).drop("own")


def repeated(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    width: int = SHINGLE,
    reach: int = 13,
    least_words: int = 20,
    recall: float = 0.95,
    most_values: int = 2,
    block: int = 128,
    seed: int = 7,
) -> DataFrame:
    """One row for each row of `df`: key, text_hash, n_paragraphs, n_repeats (repeated passages
    it holds, those that stay too), groups (the least key of each repeated group it takes part
    in, once for each paragraph), removed (structs start, end, first_key: the spans to remove,
    code points, end exclusive).

    Null and empty texts have no paragraphs; the first of a group is the least by key (nulls
    last), row and place; repeated rows keep a row each; an empty table gives an empty result.
    A passage is `least_words` or more of neighbouring repeated paragraphs, or 51 words or more
    that another row has word for word. Of such a passage without a whole repeated paragraph the
    first row that has it so keeps it, and that row's key stands for its group.
    """
    with shuffles_freed(df.sparkSession):
        return _repeated(df, key, text, threshold, width, reach, least_words, recall, most_values, block, seed)


def _repeated(df, key, text, threshold, width, reach, least_words, recall, most_values, block, seed) -> DataFrame:
    bands, rows = tuned_bands(threshold, recall, most_values)
    numbered = stored(df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), text_of(text).alias("text")), "numbered")
    buckets = (numbered.agg(F.sum(F.length("text"))).first()[0] or 0) // BUCKET + 1
    both = stored(signed(numbered, reach, width, bands * rows, seed, buckets), "paragraphs")
    shared = stored(shared_passages(both), "shared")
    marks = both.where("batch IS NULL").select("row", "key", "place", "start", "end", "words", "node", "signature")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "row", "place", "start", "end")
    classes = marks.groupBy("node").agg(
        F.min(first).alias("first"), F.min("row").alias("low"), F.max("row").alias("high"), F.first("signature").alias("signature")
    )
    named = verified_groups(stored(classes, "classes"), numbered, bands, rows, threshold, width, block)
    least = named.groupBy("component").agg(F.min("first").alias("lead"), F.min("low").alias("low"), F.max("high").alias("high"))
    leads = named.select("node", "component").join(least.where("low < high"), "component").select(F.unhex("node").alias("node"), "lead")
    hits = stored(marks.drop("signature").join(leads, "node").drop("node"), "hits")
    keys = numbered.select("row", "key")
    by_row = stored(passages(hits, shared, keys, least_words), "passages")
    counts = marks.groupBy("row").agg(F.count(F.lit(1)).alias("n_paragraphs"))
    kind = df.schema[key].dataType.simpleString()
    out = numbered.select("row", "key", F.xxhash64("text").alias("text_hash")).join(counts, "row", "left").join(by_row, "row", "left")
    return out.select(
        F.col("key").alias(key),
        "text_hash",
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("n_repeats", F.lit(0)).alias("n_repeats"),
        F.coalesce("groups", F.array().cast(f"array<{kind}>")).alias("groups"),
        F.coalesce("removed", F.array().cast(f"array<struct<start:int,end:int,first_key:{kind}>>")).alias("removed"),
    )


def passages(hits: DataFrame, shared: DataFrame, keys: DataFrame, least_words: int) -> DataFrame:
    """Rows (row, n_repeats, groups, removed): neighbouring repeated paragraphs of a row as
    passages, if they have `least_words` or meet a passage of `shared`, and the other passages
    of `shared`. A window holds the paragraphs of one text."""
    in_text = Window.partitionBy("row").orderBy("place")
    runs = hits.withColumn("run", F.col("place") - F.row_number().over(in_text))
    extent = runs.groupBy("row", "run").agg(F.min("start").alias("low"), F.max("end").alias("high"), F.sum("words").alias("total"))
    runs, extent = runs.withColumn("total", F.sum("words").over(Window.partitionBy("row", "run"))), stored(extent, "extent")
    meets = (F.col("x.row") == F.col("r.row")) & (F.col("x.start") < F.col("r.high")) & (F.col("x.end") > F.col("r.low"))
    short = extent.where(F.col("total") < least_words).alias("r").join(shared.alias("x"), meets, "left_semi")
    short = short.select("row", "run", F.lit(True).alias("met"))
    long_ones = runs.join(short, ["row", "run"], "left").where((F.col("total") >= least_words) | F.col("met"))
    stays = (F.col("row") == F.col("lead.row")) & (F.col("place") == F.col("lead.place"))
    parted = long_ones.withColumn("stays", stays)
    alike = Window.partitionBy("row", "stays").orderBy("place")
    parted = parted.withColumn("piece", F.col("place") - F.row_number().over(alike))
    spans = parted.groupBy("row", "run", "stays", "piece").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min_by("lead.key", "place").alias("first_key"),
        F.collect_set("lead.key").alias("keys"),
    )
    alone = shared.alias("x").join(extent.alias("r"), meets, "left_anti").join(keys, "row")
    place = F.struct(F.col("key").isNull().alias("none"), "key", "row", "start")
    windows = alone.select("row", "start", "end", place.alias("own"), F.explode("windows").alias("window"))
    least = windows.groupBy("window").agg(F.min("own").alias("lead"))
    alone = windows.join(least, "window").groupBy("row", "start", "end").agg(F.min("lead").alias("lead"))
    alone = alone.select(
        "row",
        (-1 - F.col("start").cast("long")).alias("run"),
        ((F.col("row") == F.col("lead.row")) & (F.col("start") == F.col("lead.start"))).alias("stays"),
        F.lit(0).alias("piece"),
        "start",
        "end",
        F.col("lead.key").alias("first_key"),
        F.array_compact(F.array("lead.key")).alias("keys"),
    )
    spans = spans.withColumn("exact", F.lit(False)).unionByName(alone.withColumn("exact", F.lit(True)))
    return spans.groupBy("row").agg(
        F.count_distinct("exact", "run").alias("n_repeats"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("groups"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct("start", "end", "first_key")))).alias("removed"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans and without the line ends that they leave behind."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end + 1 if text[end : end + 1] == "\n" else end
    return "".join([*out, text[at:]])


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`df` with the repeated passages taken out of its texts. A row is known by its key and
    text; of rows equal in both, all keep what the one that loses least keeps. A null text
    stays null; other columns stay as they are."""
    name, node, spans = (fresh(df, x) for x in ("_repeat_key", "_repeat_text", "_repeat_spans"))
    found = repeated(df, key, text, **options)
    found = found.groupBy(F.col(key).alias(name), F.col("text_hash").alias(node)).agg(F.min_by("removed", F.size("removed")).alias(spans))

    @F.pandas_udf("string")
    def apply(texts: pd.Series, removed: pd.Series) -> pd.Series:
        done = [t if t is None else cut(t, [(x["start"], x["end"]) for x in r]) for t, r in zip(texts, removed, strict=True)]
        return pd.Series(done, dtype=object)

    same = F.col(key).eqNullSafe(F.col(name)) & (F.xxhash64(text_of(text)) == F.col(node))
    joined = df.join(found.where(F.size(spans) > 0), same, "left")
    kept = F.when(F.col(spans).isNull(), F.col(text)).otherwise(apply(F.col(text), F.coalesce(spans, F.array())))
    return joined.withColumn(text, kept).select(*[f"`{c}`" for c in df.columns])


def repeats_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a document: its repeated passages, the groups they are in, the spans to remove."""
    return found.select(
        F.col(key).alias("doc_id"),
        F.col("n_repeats").cast("long").alias("n_repeats"),
        "n_paragraphs",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda x: F.concat_ws(":", x["start"], x["end"], x["first_key"])), ",").alias("removed"),
        F.array_join("groups", ",").alias("class_ids"),
    )
