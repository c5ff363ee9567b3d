"""Captured pages to rows.

Reading HTML needs a parser, so this is the one place that runs Python on the
data: mapInArrow over batches of pages, one page at a time.  Everything after
the tokens - which value wins, typing, filtering - is DataFrame work.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.scalars import clean_int, win_flag

# the tags that matter; anything else is text to be stripped
_TAG = re.compile(r"<!--.*?-->|<(/?)(div|p|strong|font|table|tr|th|td|script)\b([^>]*)>", re.S | re.I)
_SCRIPT_END = re.compile("</script", re.I)
_CLASS = re.compile(r"""class\s*=\s*["']?([^"'>]*)""", re.I)
_ANY_TAG = re.compile(r"<[^>]*>")
_ENDS = {"th", "td", "font", "table", "div"}  # tags whose end says something
_NONE: frozenset[str] = frozenset()


def _text(raw: str) -> str:
    return html_lib.unescape(_ANY_TAG.sub("", raw) if "<" in raw else raw).strip()


class _Tables:
    """Header cells and rows of every table, with the card around it.

    A card is a div of the unit block; its unit number is the text of
    p.has-text-align-center strong font.  Tags that are never closed are closed
    with the tag around them.
    """

    def __init__(self, page: str):
        self.stack = []  # (tag, classes, where its text starts)
        self.tables = []  # {"card", "summary", "head", "rows"}
        self.open_tables = []
        self.open_cards = []
        self.page = page
        pos, stack, search = 0, self.stack, _TAG.search
        while (m := search(page, pos)) is not None:
            pos = m.end()
            slash, tag, attrs = m.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                if stack and stack[-1][0] == tag:  # nearly always: nothing in between is open
                    if tag in _ENDS:
                        self._close(tag, stack[-1][2], m.start())
                    stack.pop()
                else:
                    self._end(tag, m.start())
            elif tag == "script":
                end = _SCRIPT_END.search(page, pos)
                stop = end.start() if end else len(page)
                if self.open_cards and "data: [" in page[pos:stop]:
                    self.open_cards[-1][1]["script"] = page[pos:stop]
                pos = stop
            else:
                self._start(tag, attrs, pos)

    def _start(self, tag, attrs, pos):
        found = _CLASS.search(attrs) if attrs else None
        classes = set(found.group(1).split()) if found else _NONE
        self.stack.append((tag, classes, pos))
        if tag == "div" and "wp-block-column" in classes and "is-vertically-aligned-top" in classes:
            self.open_cards.append((len(self.stack), {"unit": None, "script": ""}))
        elif tag == "table":
            card = self.open_cards[-1][1] if self.open_cards else None
            self.tables.append({"card": card, "summary": "table2" in classes, "head": [], "rows": []})
            self.open_tables.append(self.tables[-1])
        elif tag == "tr" and self.open_tables:
            self.open_tables[-1]["rows"].append([])

    def _end(self, tag, pos):
        if not any(t == tag for t, _, _ in self.stack):
            return
        while True:
            top, _, start = self.stack[-1]
            self._close(top, start, pos)
            self.stack.pop()
            if top == tag:
                return

    def _at_unit(self):
        in_p = any(t == "p" and "has-text-align-center" in c for t, c, _ in self.stack)
        return bool(self.open_cards) and in_p and any(t == "strong" for t, _, _ in self.stack)

    def _close(self, tag, start, pos):
        table = self.open_tables[-1] if self.open_tables else None
        if tag == "th" and table is not None:
            table["head"].append(_text(self.page[start:pos]))
        elif tag == "td" and table is not None and table["rows"]:
            table["rows"][-1].append(_text(self.page[start:pos]))
        elif tag == "font" and self._at_unit():
            card = self.open_cards[-1][1]
            if card["unit"] is None:
                card["unit"] = _text(self.page[start:pos])
        elif tag == "table" and self.open_tables:
            self.open_tables.pop()
        elif tag == "div" and self.open_cards and self.open_cards[-1][0] == len(self.stack):
            self.open_cards.pop()


def page_rows(html: str) -> list[tuple]:
    """(origin, position, unit, diff, game, big, reg, rate, script) of one page."""
    parser = _Tables(html or "")
    unit, values = fixed.PAGE_HEADERS[0], fixed.PAGE_HEADERS[1:]
    out, seen = [], set()
    for t in parser.tables:
        card = t["card"]
        if card is not None and card["unit"] is not None and id(card) not in seen and len(t["rows"]) >= 2:
            seen.add(id(card))  # the first table of a card counts
            cells = t["rows"][1]
            if len(cells) == len(t["head"]) and set(values) <= set(t["head"]):
                picked = [cells[t["head"].index(h)] for h in values]
                out.append(("card", len(out), card["unit"], *picked, card["script"]))
        if t["summary"] and set(fixed.PAGE_HEADERS) <= set(t["head"]):
            for cells in t["rows"]:
                if len(cells) < len(t["head"]) or cells[0] == fixed.AVERAGE_ROW:
                    continue
                picked = [cells[t["head"].index(h)] for h in values]
                out.append(("summary", len(out), cells[t["head"].index(unit)], *picked, ""))
    return out


_TOKENS = ["origin", "position", "unit", "diff", "game", "big", "reg", "combined_rate", "script"]


def extract_tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    """Text of every unit row found, one row each; other columns are kept."""
    keep = [f for f in pages.schema.fields if f.name != html]
    types = [T.StructField(c, T.IntegerType() if c == "position" else T.StringType()) for c in _TOKENS]
    schema = T.StructType(keep + types)
    names = [f.name for f in keep]

    kinds = [pa.int32() if c == "position" else pa.string() for c in _TOKENS]

    def parse(batches):
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(html).to_pylist()):
                found = page_rows(text)
                rows += found
                at += [i] * len(found)
            tokens = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
            kept = [batch.column(c).take(pa.array(at, pa.int32())) for c in names]  # the key columns stay Arrow's
            yield pa.record_batch([*kept, *tokens], names=names + _TOKENS)

    return pages.mapInArrow(parse, schema)


def extract_units(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Unit rows of captured pages, one per unit of a page.

    Values of the summary table win over those of the card; the series of the
    card's chart is kept as graph_data.
    """
    tokens = extract_tokens(pages, html)
    series = F.split(F.regexp_extract("script", r"data:\s*\[([^\]]*)\]", 1), ",")
    numbers = F.filter(F.transform(series, clean_int), lambda x: x.isNotNull())
    typed = tokens.select(
        *keys,
        "position",
        F.when(F.col("origin") == "summary", 0).otherwise(1).alias("__order"),
        clean_int(F.col("unit")).alias("machine_number"),
        *[clean_int(F.col(c)).alias(c) for c in ("diff", "game", "big", "reg")],
        "combined_rate",
        numbers.alias("graph_data"),
    ).where(F.col("machine_number").isNotNull())
    unit = [*keys, "machine_number"]
    # one aggregation, so the pages are scanned once; the chart stays with the unit
    # whatever table its numbers come from
    best = typed.groupBy(*unit).agg(
        F.min_by(F.struct("diff", "game", "big", "reg", "combined_rate"), F.struct("__order", "position")).alias("__v"),
        F.min_by("graph_data", F.when(F.size("graph_data") > 0, F.col("position"))).alias("__g"),
    )
    return best.select(*unit, "__v.*", "__g").select(
        *unit,
        "diff",
        "game",
        "big",
        "reg",
        "combined_rate",
        F.lit(0).cast("bigint").alias("max_my"),
        F.lit(0).cast("bigint").alias("max_mdia"),
        win_flag(F.col("diff")).cast("bigint").alias("win"),
        F.coalesce("__g", F.array().cast("array<bigint>")).alias("graph_data"),
    )


def extract_models(pages: DataFrame, html: str = "html", prefix: str = "kishu/?kishu=") -> DataFrame:
    """Model links of captured venue pages: shown name, encoded and decoded name."""
    keep = [c for c in pages.columns if c != html]
    quoted = prefix.replace("?", "[?]")
    link = f'<a[^>]*href="{quoted}([^"]*)"[^>]*>(.*?)</a>'
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(link), 1).alias("encoded_name"),
        F.regexp_extract_all(html, F.lit(link), 2).alias("name"),
    )
    rows = pages.select(*keep, F.posexplode(found).alias("position", "m")).select(*keep, "position", "m.*")
    return rows.withColumns(
        {
            "name": F.trim(F.regexp_replace("name", "<[^>]*>", "")),
            "decoded_name": F.try_url_decode("encoded_name"),
        }
    )
