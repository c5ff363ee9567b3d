"""Information-theoretic sanitisation of personal data.

Protected entities are the values of four patterns: mail addresses, IP addresses, card
numbers, phone numbers. Their spans are always replaced. What other terms tell about an entity
is estimated from the whole corpus: the information that a term gives about an entity is
their pointwise mutual information, log(n(e,t) N / (n(e) n(t))), with document counts, where
n(e,t) counts documents that have the term within `reach` words of the entity. Divided by
the entity's own information, log(N / n(e)), it is the share disclosed. A term beside an
entity in at least `min_texts` different texts whose share reaches `generalise` is replaced by a
placeholder, and one that reaches `remove` is taken out. Terms are sought beside an
entity only, so texts without entities stay as they are.

Pairs are taken within a reach, so a text gives rows in proportion to its entities, never
one for each pair of its terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import fresh, stored, text_of

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_PLACEHOLDERS = {k: f"<{k.upper()}>" for k in (*KINDS, TERM)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, so a run is tried once.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is tried once: what may stand before it, back to the last match, then a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each protected value, by start, then kind as listed."""
    found = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((*m.span(), 3))
    found.sort(key=lambda x: (x[0], x[2]))
    return [(s, e, KINDS[k]) for s, e, k in found]


def entity(text: str, start: int, end: int, kind: str) -> str:
    """The value as it is counted: case and separators do not matter."""
    value = text[start:end]
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub(r'[^0-9]', '', value)}"


def neighbours(text: str, spans: list[tuple[int, int, str]], reach: int) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within `reach` words on either side of a span,
    outside all spans. The search stays near the span, however long the text."""
    out = []
    window = 24 * reach
    taken = [(s, e) for s, e, _ in spans]
    for start, end, kind in spans:
        name = entity(text, start, end, kind)
        before = [(m[0], m.start(), m.end()) for m in _TERM.finditer(text, max(0, start - window), start)]
        after = [(m[0], m.start(), m.end()) for m in _TERM.finditer(text, end, min(len(text), end + window))]
        for word, s, e in before[-reach:] + after[:reach]:
            cut = (s > 0 and text[s - 1].isalpha()) or (e < len(text) and text[e].isalpha())
            if not cut and not any(a < e and s < b for a, b in taken):
                out.append((name, word.lower(), s, e))
    return out


def base_found(df: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    """Rows (key, text_hash, base, near): the spans and the terms beside them of each row."""

    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in texts:
            rows = []
            for value in values:
                spans = base_spans(value)
                near = neighbours(value, spans, reach) if spans else []
                rows.append(
                    (
                        [{"start": s, "end": e, "kind": k} for s, e, k in spans],
                        [{"entity": n, "term": t, "start": s, "end": e} for n, t, s, e in near],
                    )
                )
            yield pd.DataFrame(rows, columns=["base", "near"])

    kind = (
        "base array<struct<start: int, end: int, kind: string>>, "
        "near array<struct<entity: string, term: string, start: int, end: int>>"
    )
    found = F.pandas_udf(scan, kind)(text_of(text))
    out = df.select(F.col(key).alias("key"), F.xxhash64(text_of(text)).alias("text_hash"), found.alias("f"))
    return out.select("key", "text_hash", "f.*")


def term_documents(df: DataFrame, text: str) -> DataFrame:
    """Rows (term, n): documents that have the term; every task sums its own first."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, int] = {}
        for frame in frames:
            for value in frame["text"]:
                for term in set(_TERM.findall(value.lower())):
                    counts[term] = counts.get(term, 0) + 1
                if len(counts) > 300_000:
                    yield pd.DataFrame({"term": counts.keys(), "n": counts.values()})
                    counts = {}
        yield pd.DataFrame({"term": list(counts.keys()), "n": list(counts.values())})

    parts = df.select(text_of(text).alias("text")).mapInPandas(count, "term string, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(found: DataFrame, df: DataFrame, text: str, min_texts: int, generalise: float) -> DataFrame:
    """Rows (entity, term, share): what a term tells about an entity, from `generalise` up."""
    near = found.select("text_hash", F.explode("near").alias("x")).select("text_hash", "x.entity", "x.term")
    # documents in which the term is near the entity: copies count as documents, once for each
    one = near.groupBy("entity", "term", "text_hash").count()
    pairs = one.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts)
    documents = found.select("key", "text_hash", F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"], x["term"])))).alias("x"))
    both = documents.groupBy("x.entity", "x.term").agg(F.count(F.lit(1)).alias("n_both"))
    pairs = pairs.join(both, ["entity", "term"])
    holders = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity"))
    pairs = pairs.join(holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "entity")
    terms = pairs.select("term").distinct()
    counted = term_documents(df, text).join(terms, "term", "left_semi")
    total = found.count()
    pairs = pairs.join(counted, "term")
    own = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    told = F.log2(F.col("n_both") * F.lit(float(max(total, 1))) / (F.col("n_entity") * F.col("n")))
    share = F.when(own > 0, told / own).otherwise(F.lit(0.0))
    return pairs.withColumn("share", share).where(F.col("share") >= generalise).select("entity", "term", "share")


def found_spans(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    reach: int = 8,
    min_texts: int = 3,
    generalise: float = 0.9,
    remove: float = 0.99,
) -> DataFrame:
    """Rows (key, text_hash, base, spans), one for each row of `df`; `spans` are structs
    (start, end, kind, action) by start, then kind, `term` last; code points, end exclusive.

    A null text is empty and has no spans; null keys and repeated rows keep a row each; an
    empty table gives an empty result; other columns are left out.
    """
    found = stored(base_found(df, key, text, reach).withColumn("row", F.monotonically_increasing_id()), "entities")
    terms = disclosing_terms(found, df, text, min_texts, generalise)
    near = found.where(F.size("near") > 0).select("row", F.explode("near").alias("x")).select("row", "x.*")
    hits = near.join(terms, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("share").alias("share"))
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    spans = hits.groupBy("row").agg(
        F.collect_list(F.struct("start", "end", F.lit(TERM).alias("kind"), action.alias("action"))).alias("extra")
    )
    whole = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), F.lit("replace").alias("action")))
    order = F.create_map(*[x for i, k in enumerate((*KINDS, TERM)) for x in (F.lit(k), F.lit(i))])
    ranked = F.array_sort(
        F.transform(
            F.concat(whole, F.coalesce("extra", F.array().cast("array<struct<start:int,end:int,kind:string,action:string>>"))),
            lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), x["action"].alias("action")),
        )
    )
    out = found.join(spans, "row", "left").select(F.col("key").alias(key), "text_hash", "base", ranked.alias("spans"))
    return out.withColumn(
        "spans",
        F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["action"].alias("action"))),
    )


def redact(text: str, spans: list) -> str:
    """The text with each span replaced or taken out; a span inside an earlier one is gone with it."""
    out, at = [], 0
    for start, end, kind, action in spans:
        if end <= at:
            continue
        out.append(text[at : max(start, at)])
        out.append("" if action == "remove" else _PLACEHOLDERS[kind])
        at = end
    return "".join([*out, text[at:]])


def sanitised(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`df` with the text sanitised. Rows equal in key and text are treated alike; a null text
    stays null; other columns stay as they are."""
    names = [fresh(df, x) for x in ("_key", "_hash", "_spans")]
    spans = found_spans(df, key, text, **options).where(F.size("spans") > 0)
    spans = spans.groupBy(F.col(key).alias(names[0]), F.col("text_hash").alias(names[1])).agg(F.first("spans").alias(names[2]))

    @F.pandas_udf("string")
    def clean(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        done = [
            t if t is None or s is None else redact(t, [(x["start"], x["end"], x["kind"], x["action"]) for x in s])
            for t, s in zip(texts, all_spans, strict=True)
        ]
        return pd.Series(done, dtype=object)

    out = df.withColumn(names[1] + "d", F.xxhash64(text_of(text)))
    joined = out.join(spans, F.col(key).eqNullSafe(F.col(names[0])) & (F.col(names[1] + "d") == F.col(names[1])), "left")
    cleaned = F.when(F.col(names[2]).isNull(), F.col(text)).otherwise(clean(F.col(text).cast("string"), F.col(names[2])))
    return joined.withColumn(text, cleaned).select(*[f"`{c}`" for c in df.columns])


def pii_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(column: str):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        F.col(key).alias("doc_id"),
        *[count(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
