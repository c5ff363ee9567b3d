"""Quality rules: divergence from language references, behind length and repetition guards.

References come from the whole corpus: for each language the relative frequencies of
character classes and of its most common words. A document is compared with its language's
reference by the Jensen-Shannon distance (base 2, so 0 to 1) of both histograms; a mean of
the two above `max_divergence` rejects it. Documents below the minimum length, or made of
repeated three-word windows, fail before that; texts under `judged_words` words have too
small a sample to be compared.

References hold `top_words` words and eight classes for each of the
`most_languages` languages with the most words; other documents, and those without a
language, use the pooled reference. That bounds what is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.common import fresh, stored, text_of

CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "other")
POOLED = ""
_SYMBOLS = b"#*$%&|<>"
_STOPS = b".,;:"


def _class_table() -> np.ndarray:
    """Class of each byte; bytes that continue a character have none (8)."""
    table = np.full(256, CLASSES.index("lower"), np.uint8)  # letters beyond ASCII count as lower
    for b in range(128):
        c = chr(b)
        kind = "other"
        if c.isspace():
            kind = "space"
        elif c.isdigit():
            kind = "digit"
        elif c.isalpha():
            kind = "upper" if c.isupper() else "lower"
        elif b in _SYMBOLS:
            kind = "symbol"
        elif b in _STOPS:
            kind = "stop"
        elif c.isprintable():
            kind = "mark"
        table[b] = CLASSES.index(kind)
    table[0x80:0xC0] = len(CLASSES)
    return table


_TABLE = _class_table()
_EDGES = b" .,;:!?\"'()[]"


def class_counts(raw: bytes) -> np.ndarray:
    """Characters of each class."""
    return np.bincount(_TABLE[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def code_points(raw: bytes) -> int:
    return len(raw) - int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))


def plain(word: bytes) -> bytes:
    """The word as the common-word histograms count it."""
    return word.lower().strip(_EDGES)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts or shares."""
    p, q = p / max(p.sum(), 1e-12), q / max(q.sum(), 1e-12)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d / 2, 0.0)))


def repeated_windows(ids: np.ndarray, width: int = 3) -> int:
    """Words inside windows of `width` words that occur twice or more in the text."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    if base < 1 << 21:
        keys = (ids[:n] * base + ids[1 : n + 1]) * base + ids[2 : n + 2]
    else:
        keys = np.unique(np.stack([ids[i : n + i] for i in range(width)], 1), axis=0, return_inverse=True)[1].ravel()
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    hit = np.zeros(len(ids), bool)
    for i in range(width):
        hit[starts + i] = True
    return int(hit.sum())


def base_measures(text: str) -> tuple[list[bytes], int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, words in repeated windows."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    symbols = sum(map(raw.count, (bytes([b]) for b in _SYMBOLS)))
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    return words, code_points(b"".join(words)), symbols, dup, repeated_windows(ids)


def reference_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Rows (lang, word, n) over all documents; classes appear as words that start with a
    space. Every task sends each of its words once or a few times."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, bytes], int] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(
                [(k[0], k[1].decode("utf-8", "replace"), n) for k, n in counts.items()], columns=["lang", "word", "n"]
            )
            counts.clear()
            return out

        for frame in frames:
            for language, value in zip(frame[lang], frame[text], strict=True):
                raw = value.encode("utf-8", "surrogatepass")
                for word in map(plain, raw.split()):
                    at = language, word
                    counts[at] = counts.get(at, 0) + 1
                for name, n in zip(CLASSES, class_counts(raw).tolist(), strict=True):
                    at = language, b" " + name.encode()
                    counts[at] = counts.get(at, 0) + n
                if len(counts) > 300_000:
                    yield flush()
        yield flush()

    return docs.mapInPandas(count, "lang string, word string, n long").where("word != ''")


def references(
    docs: DataFrame, lang: str, text: str, top_words: int, most_languages: int
) -> dict[str, tuple[np.ndarray, list[str], np.ndarray]]:
    """For each language: class counts, common words, their counts followed by all others'."""
    counts = stored(reference_counts(docs, lang, text).groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    totals = counts.where("word NOT LIKE ' %'").groupBy("lang").agg(F.sum("n").alias("total"))
    large = totals.where(F.col("lang") != POOLED).orderBy(F.desc("total"), "lang").limit(most_languages)
    own = counts.join(large.select("lang"), "lang")
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "word", "n")
    both = own.unionByName(pooled)
    is_class = F.col("word").startswith(" ")
    # words alone, so that each task keeps its first `top_words` of a language before the shuffle
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = both.where(~is_class).withColumn("rank", rank).where(F.col("rank") <= top_words).drop("rank")
    top = common.unionByName(both.where(is_class))
    sums = both.where(~is_class).groupBy("lang").agg(F.sum("n").alias("n"))
    rows = top.collect()  # bounded: languages x (words + classes)
    total = {r["lang"]: r["n"] for r in sums.collect()}
    out = {}
    for language in {r["lang"] for r in rows}:
        own_rows = {r["word"]: r["n"] for r in rows if r["lang"] == language}
        words = sorted((w for w in own_rows if not w.startswith(" ")), key=lambda w: (-own_rows[w], w))
        shares = np.array([own_rows[w] for w in words], float)
        rest = max(total.get(language, 0) - shares.sum(), 0)
        classes = np.array([own_rows.get(" " + c, 0) for c in CLASSES], float)
        out[language] = classes, words, np.append(shares, rest)
    return out


def quality(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    top_words: int = 64,
    most_languages: int = 500,
    min_words: int = 50,
    max_repeat_pct: int = 50,
    max_divergence: float = 0.34,
    judged_words: int = 50,
) -> DataFrame:
    """`df` with a struct `quality`: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, class_distance, word_distance, base_failed, kept.

    A column `quality` of `df` gives way. Null and empty texts have no words and fail the
    length rule; their distances are null, like those of texts under `judged_words` words.
    Null languages use the pooled reference. Repeated rows are judged alike; an empty table
    gives an empty result.
    """
    df = df.drop("quality")
    language, value = fresh(df, "_lang"), fresh(df, "_text")
    has_lang = lang in df.columns
    language_of = F.coalesce(F.col(lang).cast("string"), F.lit(POOLED)) if has_lang else F.lit(POOLED)
    docs = df.select(language_of.alias(language), text_of(text).alias(value))
    known = references(docs, language, value, top_words, most_languages)
    sent = {k: (c, {w.encode(): i for i, w in enumerate(ws)}, n) for k, (c, ws, n) in known.items()}
    fields = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double"

    def judge(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for languages, texts in frames:
            rows = []
            for name, raw_text in zip(languages, texts, strict=True):
                words, chars, symbols, dup, repeat = base_measures(raw_text)
                of_class = of_words = None
                if len(words) >= judged_words and (reference := sent.get(name) or sent.get(POOLED)):
                    classes, index, shares = reference
                    of_class = distance(class_counts(raw_text.encode("utf-8", "surrogatepass")).astype(float), classes)
                    rest = len(shares) - 1
                    at = [index.get(plain(w), rest) for w in words]
                    of_words = distance(np.bincount(at, minlength=rest + 1).astype(float), shares)
                rows.append((len(words), chars, symbols, dup, repeat, of_class, of_words))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    measured = F.pandas_udf(judge, fields)(language_of, text_of(text))
    q: Column = F.col("quality")
    failed = (q["n_words"] < min_words) | (F.lit(100) * q["n_repeat_words"] > F.lit(max_repeat_pct) * q["n_words"])
    diverges = (q["class_distance"] + q["word_distance"]) / 2 > max_divergence
    out = df.withColumn("quality", measured)
    return out.withColumn(
        "quality",
        F.struct("quality.*", failed.alias("base_failed"), (~failed & ~F.coalesce(diverges, F.lit(False))).alias("kept")),
    )


def quality_digest(judged: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a document with the measures and the verdict."""
    return judged.select(F.col(key).alias("doc_id"), "quality.*")
