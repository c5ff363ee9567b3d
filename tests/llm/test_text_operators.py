"""The text operators against brute force, on small tables with nulls, empty texts, copies and clashing names."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from floorlens.llm import (
    chat_repair,
    decontaminate,
    html_text,
    ngram_join,
    packing,
    paragraph_dedup,
    pii,
    pitman_yor,
    quality,
    sharding,
    similar,
)
from floorlens.llm.common import WordHashes, words_of

RNG = random.Random(5)
WORDS = ["ba", "ce", "di", "fo", "gu", "haku", "ile", "jono", "kari", "lumo", "mita", "näkö"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(WORDS) for _ in range(r.randint(1, 3))) for _ in range(n))


def edited(text, at, word):
    words = text.split(" ")
    words[at] = word
    return " ".join(words)


BASE = [prose(80, i) for i in range(12)]
PASSAGE = prose(60, 99)
TEXTS = [
    *BASE,
    BASE[0],
    BASE[0],
    edited(BASE[1], 40, "zzz"),
    edited(edited(BASE[2], 5, "yyy"), 70, "xxx"),
    "first line here\n" + PASSAGE + "\nlast",
    "another beginning\n" + PASSAGE,
    "",
    None,
    "!!!",
    "one two",
    "mail me at a.b@c-d.example.org or 10.0.0.1, +1 (555) 123-4567, card 4111 1111 1111 1111.",
    prose(9000, 7),
    ("same three words " * 60).strip(),
    ("#### $$$$ %%%% " * 40).strip(),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", i, "clash") for i, t in enumerate(TEXTS)]
    rows.append((None, prose(60, 3), "en", "s", 1, "null key"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, bucket long, quality string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def linked(texts, threshold=0.8):
    """Links and least member of each text's group, by comparing all pairs."""
    hashes = WordHashes()
    unique = list(dict.fromkeys(texts))
    sets = [set(similar.shingle_set(t, hashes).tolist()) for t in unique]
    links, lead = Counter(), {t: i for i, t in enumerate(unique)}
    changed = True
    pairs = [(i, j) for i in range(len(unique)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    for i, j in pairs:
        links[unique[i]] += 1
        links[unique[j]] += 1
    while changed:
        changed = False
        for i, j in pairs:
            low = min(lead[unique[i]], lead[unique[j]])
            for k in (i, j):
                if lead[unique[k]] != low:
                    lead[unique[k]], changed = low, True
    return links, {t: unique[n] for t, n in lead.items()}


def test_ngram_join(docs, nothing):
    got = by_id(ngram_join.joined(docs))
    texts = {i: (t or "") for i, t in enumerate(TEXTS)} | {None: prose(60, 3)}
    links, lead = linked(list(texts.values()))
    for i, t in texts.items():
        assert got[i]["n_links"] == links[t], i
        if i is not None:
            assert got[i]["class_id"] == min(k for k, x in texts.items() if k is not None and lead[x] == lead[t])
            assert got[i]["n_copies"] == list(texts.values()).count(t)
    assert ngram_join.joined(nothing).count() == 0
    kept = ngram_join.deduplicated(docs.unionByName(docs.where("doc_id = 3")))
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({r["class_id"] for r in got.values()})


def test_pairs_at_the_threshold_beside_a_large_group(spark):
    """300 near copies at 0.93 have 44,850 pairs; they must not hide lone pairs at 0.80 exactly."""
    base = prose(280, 1000)
    texts = [edited(base, 10 * (i % 27) + 5, f"w{i}") for i in range(300)]
    for i in range(300):
        words = [f"p{i}x{j}" for j in range(49)]
        texts += [" ".join(words), edited(" ".join(words), 24, "other")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(ngram_join.joined(df))
    missed = [i for i in range(300, 900, 2) if got[i]["n_links"] != 1 or got[i + 1]["class_id"] != i]
    assert len(missed) <= 1  # 0.999 of 300
    trees, depth = ngram_join.tuned_forest(0.8, 0.999)
    assert 1 - (1 - 0.8**depth) ** trees >= 0.999


def test_large_group_of_near_copies_in_blocks(spark):
    """More near copies than a block holds: every link counts, no pair is a row."""
    base = prose(200, 50)
    texts = [edited(base, 10 * (i % 19) + 3, f"w{i}") for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(ngram_join.joined(df, block=7))
    links, _ = linked(texts)
    assert [got[i]["n_links"] for i in range(60)] == [links[t] for t in texts]
    assert {r["class_id"] for r in got.values()} == {0}


def test_components_of_paths_and_stars(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)] + [("x0", f"x{i}") for i in range(1, 30)]
    got = {r["node"]: r["component"] for r in similar.components(spark.createDataFrame(edges, "node string, other string")).collect()}
    assert len(got) == 71 and set(got.values()) == {"000", "x0"}


def test_chat_costs_are_least():
    def brute(roles):
        best = [41]

        def go(i, state, cost):
            if cost >= best[0]:
                return
            if i == len(roles) and state == chat_repair.ASSISTANT:
                best[0] = cost
                return
            for to in chat_repair._NEXT[state]:
                go(i, to, cost + chat_repair.INSERT_COST)
            if i < len(roles):
                for state_, to, more, _ in chat_repair.choices(roles[i]):
                    if state_ == state:
                        go(i + 1, to, cost + more)

        go(0, 0, 0)
        return best[0]

    r = random.Random(2)
    for _ in range(60):
        roles = [r.randint(0, 3) for _ in range(r.randint(0, 5))]
        cost = chat_repair.segment_matrix(roles)[chat_repair.START]
        end = chat_repair.ended(cost)
        assert cost[end] + chat_repair._INSERT[end, chat_repair.ASSISTANT] == brute(roles)


def test_chat_segments_give_the_same_repair(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(["system", "user", "assistant", "tool", None]), r.choice(["hi", "", None, "text"])) for c in (1, 2, None) for t in range(30)]
    rows += [(3, None, "user", "x"), (3, 1, "user", "x"), (3, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, cut = (by_id(chat_repair.rendered(chat_repair.repaired(df, segment=n)), "conv_id") for n in (512, 4))
    assert {c: x["cost"] for c, x in whole.items()} == {c: x["cost"] for c, x in cut.items()}
    for x in [*whole.values(), *cut.values()]:
        roles = re.findall(r"<\|(\w+)\|>", x["text"])
        assert len(roles) == x["n_turns"] and roles[-1] == "assistant"
        roles = roles[1:] if roles[0] == "system" else roles
        assert roles == ["user", "assistant"] * (len(roles) // 2)
    assert chat_repair.rendered(chat_repair.repaired(df.where("false"))).count() == 0


def test_shards(docs, nothing, spark):
    many = docs.unionByName(docs).crossJoin(spark.range(9)).drop("id")
    rows = sharding.shard_digest(sharding.shuffled_shards(many)).collect()
    assert len(rows) == many.count()
    for shard in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 16, len(rows) // 16 + 1)
    for r in rows:
        if r["doc_id"] is not None:
            raw = (TEXTS[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert sharding.shuffled_shards(nothing).count() == 0
    # the order is mixed: neighbours in a shard are not neighbours in the table
    first = [r["doc_id"] for r in sorted((r for r in rows if r["shard"] == 0), key=lambda r: r["slot"])]
    assert first != sorted(first, key=lambda x: -1 if x is None else x)


def test_packing(docs, nothing):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.packed(docs).collect()
    by_doc, by_bin = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_bin.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == {*range(len(TEXTS)), None}
    for i, parts in by_doc.items():
        text = prose(60, 3) if i is None else TEXTS[i] or ""
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
        parts.sort(key=lambda p: p["piece"])
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in parts]).tolist() == ids
        assert all(p["length"] == 4096 for p in parts[:-1])
    for parts in by_bin.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    assert packing.packed(nothing).count() == 0


def test_open_bins_are_best_fit():
    bins, r = packing.OpenBins(100, 5), random.Random(1)
    space, open_bins = {}, []
    for _ in range(500):
        length = r.randint(1, 100)
        number, offset = bins.place(length)
        fits = [b for b in open_bins if space[b] >= length]
        if fits:
            assert space[number] == min(space[b] for b in fits)
        else:
            if len(open_bins) == 5:
                closed = next(b for b in open_bins if not any(b in stack for stack in bins.by_space))
                assert space[closed] == min(space[b] for b in open_bins)
                open_bins.remove(closed)
            space[number] = 100
            open_bins.append(number)
        assert offset == 100 - space[number]
        space[number] -= length
        if not space[number]:
            open_bins.remove(number)


def test_decontamination(docs, nothing, spark):
    items = [(1, " ".join(BASE[3].split()[10:40])), (2, PASSAGE[:80]), (3, "one TWO"), (4, ""), (5, None), (6, prose(30, 1234)), (6, "one TWO")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = words_of(t)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + min(10, len(w))]), set()).add(str(i))
    got = by_id(decontaminate.decontamination_digest(decontaminate.decontaminated(docs, bench)))
    for i, t in enumerate(TEXTS):
        w, hit, found = words_of(t), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if k + n <= len(w) and (names := windows.get(tuple(w[k : k + n]))):
                    hit.update(range(k, k + n))
                    found |= names
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found)), i
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert decontaminate.decontaminated(nothing, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.decontaminated(docs, bench.where("false")).collect())


def test_decontamination_of_long_copied_passages(spark):
    """Rows of the join carry a window's words, not their passage; words beyond the benchmark's length part a passage."""
    long = " ".join(f"w{i}" for i in range(20_000))
    cut = " ".join([*long.split()[:300], "x" * 1_000_000, *long.split()[300:305]])
    bench = spark.createDataFrame([("a", long), ("b", "w7 w8")], "item_id string, text string")
    rows = [*((i, long) for i in range(4)), (4, cut), (5, "w1 " * 20_000), (6, None)]
    found = decontaminate.decontaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], ",".join(r["items"])) for r in found.collect()}
    assert got == {**{i: (20_000, 20_000, "a,b") for i in range(4)}, 4: (306, 300, "a,b"), 5: (20_000, 0, ""), 6: (0, 0, "")}
    runs = spark.createDataFrame([(0, 50, long.split())], "row long, start long, words array<string>")
    tokens = decontaminate.shingles_of(runs, [2, 5], 5, 10)
    widest = tokens.selectExpr("count(1) as n", "max(size(split(around, ' '))) as words", "min(place) as low").first()
    assert widest == (19_999 + 19_996, 15, 50)


def test_pii_base_spans_equal_the_patterns():
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def valid(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 10 <= len(digits) <= 15

    r = random.Random(3)
    texts = ["".join(r.choice("a1.@-+5 (%49") for _ in range(r.randint(0, 40))) for _ in range(4000)] + [t for t in TEXTS if t]
    for text in texts:
        found = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(patterns.items()) for m in re.finditer(p, text) if valid(k, m[0])]
        assert pii.base_spans(text) == [(s, e, k) for s, _, e, k in sorted(found)]


def test_pii_terms_that_disclose(spark):
    """`zebrafish` stands beside one address in every text that has it; `common` stands everywhere."""
    rows = [(i, f"text {prose(3, i)} zebrafish common writes from x@y.example {prose(3, i + 100)}") for i in range(4)]
    rows += [(10 + i, f"common {prose(8, i)}") for i in range(30)] + [(50, None), (51, ""), (50, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(df).collect()}
    assert all("zebrafish" not in out[i] and "common" in out[i] and "<EMAIL>" in out[i] for i in range(4))
    assert all(out[10 + i] == dict(rows)[10 + i] for i in range(30)) and out[50] is None and out[51] == ""
    assert pii.found_spans(df.where("false")).count() == 0
    digest = by_id(pii.pii_digest(pii.found_spans(df)))
    assert digest[0]["n_email"] == 1 and "term:" in digest[0]["spans"] and digest[12]["spans"] == ""


def passages_by_hand(rows, reach=13, least=20, threshold=0.8):
    """(n_repeats, removed spans) of each row of (key, text), by comparing all pairs of paragraphs."""
    hashes, units = WordHashes(), []
    for i, (_, t) in enumerate(rows):
        for place, (start, end, words, _) in enumerate(paragraph_dedup.paragraphs(t or "", reach, hashes)):
            units.append((i, place, start, end, len(words), frozenset(similar.shingle_hashes(words, 5).tolist()), words.tobytes()))
    classes = list(dict.fromkeys(u[6] for u in units))
    shingles = {u[6]: u[5] for u in units}
    group = {c: n for n, c in enumerate(classes)}
    for x in classes:
        for y in classes:
            if group[x] != group[y] and len(shingles[x] & shingles[y]) >= threshold * len(shingles[x] | shingles[y]) - 1e-9:
                old, kept = group[x], group[y]
                group = {c: kept if n == old else n for c, n in group.items()}
    held, lead = {}, {}
    for i, place, *_, c in units:
        held.setdefault(group[c], set()).add(i)
        mark = (rows[i][0] is None, rows[i][0] or 0, i, place)
        lead[group[c]] = min(lead.get(group[c], mark), mark)
    out = []
    for i in range(len(rows)):
        own, runs = [u for u in units if u[0] == i], []
        for u in own:
            if len(held[group[u[6]]]) > 1:
                if runs and runs[-1][-1][1] == u[1] - 1:
                    runs[-1].append(u)
                else:
                    runs.append([u])
        runs = [r for r in runs if sum(u[4] for u in r) >= least]
        removed = []
        for run in runs:
            gone = [u for u in run if lead[group[u[6]]][2:] != (i, u[1])]
            for k, u in enumerate(gone):
                if k and gone[k - 1][1] == u[1] - 1:
                    removed[-1] = (removed[-1][0], u[3])
                else:
                    removed.append((u[2], u[3]))
        out.append((len(runs), removed))
    return out


SHARED = prose(75, 501)
REPEATS = [
    (1, prose(300, 502) + " " + SHARED + " " + prose(200, 503)),  # inside one long line
    (2, prose(90, 504) + ", " + SHARED + "; " + prose(400, 505)),
    (3, "\n".join(SHARED.split(" ")[k : k + 6][0] + " " + " ".join(SHARED.split(" ")[k : k + 6][1:]) for k in range(0, 75, 6))),  # short lines
    (4, prose(120, 506)),
    (5, (prose(30, 507) + "\n") * 3),  # repeated in this text only
    (6, edited(prose(120, 508), 60, "änderung")),
    (7, prose(120, 508)),
    (7, prose(120, 509)),
    (None, re.sub("[a-z]", lambda m: m[0].upper(), prose(120, 509))),
    (None, None),
    (8, ""),
    (9, "x y " * 4000),
    (9, "x y " * 4000),
]


def test_repeated_paragraphs(spark, docs, nothing):
    df = spark.createDataFrame([(k, t, "clash", i) for i, (k, t) in enumerate(REPEATS)], "doc_id long, text string, node string, row int").coalesce(1)
    got = paragraph_dedup.repeated(df).collect()
    made = Counter((r["doc_id"], r["n_repeats"], tuple((s["start"], s["end"]) for s in r["removed"])) for r in got)
    expected = passages_by_hand(REPEATS)
    assert made == Counter((k, n, tuple(spans)) for (k, _), (n, spans) in zip(REPEATS, expected, strict=True))
    found = {i for i, (n, _) in enumerate(expected) if n}
    assert {0, 1, 2, 5, 6, 7, 8, 11, 12} == found
    assert paragraph_dedup.repeated(nothing).count() == 0 and paragraph_dedup.repeated(docs).count() == docs.count()


def test_repeated_paragraphs_taken_out(spark):
    df = spark.createDataFrame([(k, t, "clash") for k, t in REPEATS], "doc_id long, text string, node string").coalesce(1)
    out = paragraph_dedup.without_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    texts = [(r["doc_id"], r["text"]) for r in out.collect()]
    for i in (0, 3, 4, 5, 9, 10):
        assert REPEATS[i] in texts
    second = next(t for k, t in texts if k == 2)
    words = SHARED.split(" ")
    assert prose(90, 504) in second and prose(400, 505) in second and " ".join(words[28:48]) not in second
    digest = by_id(paragraph_dedup.repeats_digest(paragraph_dedup.repeated(df.where("doc_id < 5"))))
    assert digest[2]["n_repeats"] == 1 and digest[2]["class_ids"] == "1" and digest[4]["n_repeats"] == 0


def test_passages_without_a_whole_paragraph(spark):
    """Any 51 words that two rows share are found, wherever they are cut; 41 words are not."""
    rows, shared = [], {}
    for i in range(60):
        n = 53 if i < 30 else 41
        words = prose(n, 2000 + i)
        for side in (0, 1):
            shared[2 * i + side] = n
            rows.append((2 * i + side, f"{prose(30 + 7 * i % 40, 3000 + 2 * i + side)} {words} {prose(60, 5000 + 2 * i + side)}"))
    rows += [(500, None), (501, ""), (502, f"{prose(60, 7000)} {prose(60, 7001)} {prose(60, 7000)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in paragraph_dedup.repeats_digest(paragraph_dedup.repeated(df, least_words=51)).collect()}
    assert len(got) == len(rows)
    for key, n in shared.items():
        assert got[key]["n_repeats"] == (n > 50), (key, n)
        assert (got[key]["n_removed"] > 0) == (n > 50 and key % 2 == 1)  # the first row keeps it
    assert all(got[k]["n_repeats"] == 0 for k in (500, 501, 502))


def test_chosen_windows_of_a_shared_run():
    hashes = WordHashes()
    for seed in range(30):
        run = hashes.of(words_of(prose(51, 800 + seed)))
        texts = [np.concatenate([hashes.of(words_of(prose(n, 900 + seed + n))), run, hashes.of(words_of(prose(20, seed + n)))]) for n in (3, 71)]
        text, first, values = paragraph_dedup.chosen_windows([texts[0], run[:50], texts[1]])
        assert set(values[text == 0].tolist()) & set(values[text == 2].tolist()) and not (text == 1).any()
        whole = np.concatenate([texts[0], run[:50], texts[1]])
        assert all(len(set(values[np.all([(whole[first + k] == whole[f + k]) for k in range(42)], axis=0)].tolist())) == 1 for f in first.tolist())


def test_all_pairs_of_a_large_group_are_compared(spark):
    """A group beyond the block size has the components of all its pairs, whatever further hash values say, and many
    copies give about a row each."""
    r = random.Random(8)
    sets = {}
    for family in range(30):
        base = r.sample(range(1000, 10**6), 18)
        for member in range(5):
            sets[f"N{family:02}{member}"] = sorted({1, 2, *base[: 18 - r.randint(0, 1)], *r.sample(range(10**6, 10**7), r.randint(0, 3))})
    alike = {f"C{i:03}": [1, 2, *range(3, 30), 100 + i] for i in range(150)}
    for held, most in ((sets, None), (alike, 3 * len(alike))):
        pack = [(n, np.array(x, "<u8").tobytes(), [i * 7 + k for k in range(4)]) for i, (n, x) in enumerate(held.items())]
        shingles = spark.createDataFrame(pack, "node string, shingles binary, more array<bigint>")
        groups = spark.createDataFrame([(5, n) for n in held], "group long, node string")
        found = [(x[0], x[1]) for x in paragraph_dedup.paragraph_links(groups, shingles, 0.8, 16).collect()]
        want = similar.forest(np.array([[a < b and len({*held[a]} & {*held[b]}) >= 0.8 * len({*held[a]} | {*held[b]}) - 1e-9 for b in held] for a in held]), [*held], [*held])
        full = np.ones((1, 1), bool)
        assert want and not [e for a, b in want for e in similar.forest(full, [a], [b], _spanned(found, a, b))]
        assert not [e for a, b in found for e in similar.forest(full, [a], [b], _spanned(want, a, b))]
        assert most is None or len(found) < most


def _spanned(edges, a, b):
    """[(a, b)] if the edges connect them, else nothing."""
    seen, left = {a}, [a]
    near = {}
    for x, y in edges:
        near.setdefault(x, []).append(y)
        near.setdefault(y, []).append(x)
    while left:
        for y in near.get(left.pop(), []):
            if y not in seen:
                seen.add(y)
                left.append(y)
    return [(a, b)] if b in seen else []


def test_paragraph_cuts_follow_the_words():
    hashes = WordHashes()
    for seed in range(40):
        words = hashes.of(words_of(prose(60, 600 + seed)))
        first, second = (np.concatenate([hashes.of(words_of(prose(n, 700 + seed + n))), words]) for n in (33, 71))
        ends = [{at - len(x) for at in paragraph_dedup.cuts(x, 13) if len(x) - 46 <= at < len(x) - 14} for x in (first, second)]
        assert ends[0] == ends[1]
    for text in ("", "one", "one two", "a " * 50_000):
        spans = list(paragraph_dedup.paragraphs(text, 13, hashes))
        assert sum(len(w) for _, _, w, _ in spans) == len(words_of(text)) and all(len(w) <= 64 for _, _, w, _ in spans)
        assert all((similar.shingle_hashes(w, 5) == s).all() for _, _, w, s in spans)


def test_quality(docs, nothing):
    got = by_id(quality.quality_digest(quality.quality(docs)))
    for i, t in enumerate(TEXTS):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        counts = Counter(windows)
        repeat = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
        lines, seen, dup = (t or "").split("\n"), set(), 0
        for line in lines:
            dup += bool(line.strip()) and line in seen
            seen.add(line)
        r = got[i]
        expected = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(repeat)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected, i
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert got[0]["kept"] and not got[len(TEXTS) - 1]["kept"]
    assert quality.quality(nothing).count() == 0
    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert quality.distance(p, q) == pytest.approx(1) and quality.distance(p, p) == 0


def test_language_model(docs, nothing):
    got = by_id(pitman_yor.scored(docs, block_tokens=500))
    tokens = {i: (prose(60, 3) if i is None else TEXTS[i] or "").encode().lower().split() + [b""] for i in got}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in got}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(ws), total)
        assert r["n_known"] == sum(w in counts for w in ws)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws))
        assert r["score"] < 0
    assert pitman_yor.scored(nothing).count() == 0


def test_language_model_knows_the_word_before(spark):
    """The same words in another order score lower, unseen words by their spelling."""
    r = random.Random(11)
    follow = {w: r.sample(WORDS, 2) for w in WORDS}

    def walk(n):
        out = [r.choice(WORDS)]
        while len(out) < n:
            out.append(r.choice(follow[out[-1]]))
        return out

    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 != 2]
    probe = walk(200)
    mixed = r.sample(probe, len(probe))
    rows = [(i, " ".join(walk(60))) for i in train]
    rows += [(held[0], " ".join(probe)), (held[1], " ".join(mixed)), (held[2], "ba kuha"), (held[3], "ba qxzwv")]
    got = by_id(pitman_yor.scored(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=3000, bucket_tokens=5000))
    assert got[held[0]]["base_score"] == pytest.approx(got[held[1]]["base_score"])
    assert got[held[0]]["score"] > got[held[1]]["score"] + 50 and got[held[0]]["score"] > got[held[0]]["base_score"] + 50
    assert got[held[2]]["base_score"] == pytest.approx(got[held[3]]["base_score"]) and got[held[2]]["score"] > got[held[3]]["score"]


def test_tables_are_drawn_from_their_law():
    """Against the law summed over all seatings of five customers; large dishes by reseating."""

    def partitions(items):
        if not items:
            yield []
            return
        for rest in partitions(items[1:]):
            yield [[items[0]], *rest]
            for i in range(len(rest)):
                yield rest[:i] + [[items[0], *rest[i]]] + rest[i + 1 :]

    discount, weight, law = 0.4, 0.7, np.zeros(6)
    for seating in partitions(list(range(5))):
        law[len(seating)] += weight ** len(seating) * math.prod(math.prod(i - discount for i in range(1, len(t))) for t in seating)
    law /= law.sum()
    rng = np.random.default_rng(3)
    n = 20_000
    tables, kept = pitman_yor.drawn_tables(np.full(n, 5), np.full(n, weight), discount, rng)
    assert np.bincount(tables, minlength=6) / n == pytest.approx(law, abs=0.015) and kept == [None] * n
    sizes, seen = [np.array([5])], []
    for _ in range(n // 4):
        sizes = pitman_yor.reseated(sizes, np.array([weight]), discount, None, rng)
        seen.append(len(sizes[0]))
    assert np.bincount(seen, minlength=6) / len(seen) == pytest.approx(law, abs=0.03)
    tables, kept = pitman_yor.drawn_tables(np.array([1, 5000, 0]), np.array([1.0, 3.0, 1.0]), discount, rng)
    assert tables[0] == 1 and tables[2] == 0 and kept[1].sum() == 5000 and len(kept[1]) == tables[1] and kept[0] is None


def test_seating_keeps_its_customers():
    rng = np.random.default_rng(1)
    count = np.array([2, 3, 10, 500, 7])
    weight = np.array([0.01, 1.0, 5.0, 20.0, 1e-9])
    sizes = pitman_yor.seated(count, pitman_yor.mean_tables(count, weight, 0.5))
    runs = []
    for _ in range(3000):
        sizes = pitman_yor.reseated(sizes, weight, 0.5, 1, rng)
        assert [s.sum() for s in sizes] == count.tolist() and all((s > 0).all() for s in sizes)
        runs.append(len(sizes[0]))
    # two customers: one table with weight (1 - d), two with the weight of a new table
    assert np.mean(np.array(runs) == 2) == pytest.approx(0.01 / (0.01 + 0.5), abs=0.02)


def test_main_text_of_pages(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>'</script></head><body><header><p>Site head</p></header><nav><ul><li><a href=x>Home</a></ul></nav>"
        "<div class='ad'>Buy now</div><article><h1>A &amp; B</h1><p>First   para<br>goes on.<p>Ti.<div class='cookie-notice'>We use cookies</div>"
        "<aside>More</aside><form><input><label>Mail</label></form></article><section id=comments><p>A reader says a very long thing about it</p></section>"
        "<footer>&copy; x</footer></body></html>"
    )
    plain = "<body><div id=menu><a href=a>a</a><a href=b>b</a></div><div><p>" + prose(80, 1) + "</p><p>Short.</p></div><div class=footer>x</div></body>"
    rows = [(1, "u", page, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (4, "u", plain, "x"), (5, None, "<p>" + "ab " * 50000, "x"), (5, None, "just text", "x")]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    texts = [r["text"] for r in got]
    assert texts[0] == "A & B\nFirst para goes on.\nTi."
    assert texts[1] == texts[2] == "" and texts[3] == prose(80, 1) + "\nShort." and texts[5] == "just text"
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_main_text_is_where_the_cluster_is():
    """A teaser in an article is not the page; several articles with the text are."""
    body = "".join(f"<p>{prose(30, i)}.</p>" for i in range(8))
    plain = [f"{prose(30, i)}." for i in range(8)]
    teaser = f"<article><p>{prose(12, 50)}</p></article>"
    assert html_text.main_text(f"<body><div class=content>{body}</div>{teaser}</body>").split("\n")[:8] == plain
    assert html_text.main_text(f"<body>{teaser}<div>{body}</div></body>").split("\n")[-8:] == plain
    two = f"<body><div>short words here</div><article>{body}</article><article>{body}</article></body>"
    assert html_text.main_text(two).split("\n") == plain * 2
    assert html_text.main_text(f"<body><div><p>aside</p></div><main><h1>T</h1>{body}</main></body>").split("\n") == ["T", *plain]


def test_main_text_of_deep_and_broken_pages():
    """Time grows with the page: nested, unmatched and unclosed elements are looked up, not searched."""
    n = 100_000
    words = "\n".join(["word"] * n)
    start = time.perf_counter()
    assert html_text.main_text("<div>word " * n).count("word") >= 0.9 * n  # the innermost element with 0.9 of the cluster
    assert html_text.main_text("<b>" * n + "word</i>" * n).count("word") == n
    assert html_text.main_text("<p><div>" + "<b>" * n + "<hr>word" * n) == words
    assert html_text.main_text("<ul>" + "<li><i>word" * n) == words
    assert time.perf_counter() - start < 60

def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    item = " ".join(BASE[3].split()[10:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {0, 1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 23} <= out
    assert not out & {3, 12, 13, 14, 18, 19, 20, 21, 24, 25}


def test_pipeline_keeps_texts_with_null_or_shared_ids_apart(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string"
    item = " ".join(BASE[3].split()[10:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, BASE[3]), (None, BASE[4]), (7, BASE[3]), (7, BASE[5]), (8, BASE[6]), (None, None)]
    left = corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(rows, schema), str(tmp_path))
    assert left.columns == ["doc_id", "text"]
    assert Counter(map(tuple, left.collect())) == Counter([(None, BASE[4]), (7, BASE[5]), (8, BASE[6]), (None, None)])

    near = [edited(t, 40, "zzz") for t in BASE]
    rows = [(None, BASE[0]), (None, near[0]), (None, near[0])]  # a group without a key: one of it stays
    rows += [(1, BASE[1]), (None, near[1])]  # null beside a key: the key leads
    rows += [(2, BASE[2]), (3, near[2]), (3, BASE[3]), (4, near[3])]  # 3 leads one group and follows in another
    rows += [(5, BASE[4]), (5, near[4]), (5, BASE[5])]  # one key: a group and a lone text
    df = spark.createDataFrame(rows, schema)
    kept = Counter(map(tuple, corpus_pipeline.near_duplicate_stage(spark, df, str(tmp_path)).collect()))
    for a, b in ((0, {None}), (1, {1}), (2, {2}), (3, {3}), (4, {5}), (5, {5})):
        found = [k for k in kept.elements() if k[1] in (BASE[a], near[a])]
        assert len(found) == 1 and found[0][0] in b, a
    assert sum(kept.values()) == 6


def test_packing_remembers_no_long_chunks(spark):
    """A text of 20 MB without a space is packed in whole, and does not stay in memory."""
    from tokenizers import Tokenizer

    import public_tokenizers

    memory = packing.ChunkIds(None)
    long = "ab3é" * 100_000
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(long, add_special_tokens=False).ids
    assert memory.ids_of(long + " ba") == np.array([*whole, *memory.tokenizer.encode("ba", add_special_tokens=False).ids], np.uint32).tobytes()
    assert max(map(len, [*memory, *memory.words])) <= memory.LONGEST
    rows = spark.createDataFrame([(1, "7" * 20_000_000), (2, None), (3, "ba")], "doc_id long, text string")
    pieces = packing.packed(rows).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {x["doc_id"]: x[1] for x in pieces} == {1: 20_000_001, 2: 1, 3: len(memory.ids_of("ba")) // 4 + 1}
