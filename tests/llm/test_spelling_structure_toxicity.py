"""Spelling variants and structure repair against brute force; toxicity by held-out accuracy."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from floorlens.llm import spelling, structure_repair, toxicity

EMPTY = hashlib.sha256().hexdigest()


# spelling


def brute_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    form, near_of = {}, {}
    for w, n in words.items():
        near_of[w] = [v for v in words if v != w and near(w, v)]
        best = min(near_of[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def spelled_rows():
    r = random.Random(4)
    stems = ["lettre", "lettres", "létter", "planet", "planets", "planeta", "garden", "gardens", "wardens", "warden", "ÀÖÿßx", "mañana"]
    rows = []
    for i in range(300):
        text = []
        for _ in range(r.randint(0, 40)):
            w = r.choice(stems)
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", "e", "s", "Ö", w[at] * 2]) + w[at + 1 :]
            text.append(r.choice([w, w.upper(), w.title()]))
        rows.append((i, r.choice([" ", ", ", "\n", " ŁŁ "]).join(text)))
    rows += [(7, rows[7][1])] * 3 + [(None, "planet planet"), (400, None), (401, ""), (402, "123 _ ×÷×÷×÷")]
    rows.append((404, "stone " * 4 + "stones " * 9 + "stonest " * 20 + "ostonest " * 50))
    rows.append((403, "gardenes " * 100 + "x" * 30000 + " " + ("y" * 2500 + " " + "y" * 2501 + " ") * 4))
    return rows


def test_spelling_variants_equal_brute_force(spark, monkeypatch):
    rows = spelled_rows()
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, word string")
    got = sorted(tuple(x) for x in spelling.variants(spelling.word_counts(df)).collect())
    want = brute_variants(brute_words(rows))
    assert got == want
    assert any(x[1] for x in got) and any(x[2] not in (x[0], x[1]) for x in got)


def test_spelling_in_small_blocks_and_slices(spark, monkeypatch):
    """Blocks of a few words meet in parts; runs across slices are not cut."""
    rows = spelled_rows()
    words = brute_words(rows)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 2)
    df = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = spelling.near_pairs(df).collect()
    assert len({frozenset(x) for x in got}) == len(got)
    assert {frozenset(x) for x in got} == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    text = " ".join(str(t) for _, t in rows)
    whole = sum(spelling.runs_of(text), Counter())
    monkeypatch.setattr(spelling, "_SLICE", 13)
    assert sum(spelling.runs_of(text), Counter()) == whole


def test_spelling_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(df)).collect() == []


# structure


def brute_structure(rows):
    def plain(x):
        return " " if x is None else str(x)

    out, turns = {}, {}
    for conv, turn, role, text in rows:
        at = turns.setdefault(conv, [])
        kind = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        role, text = plain(role), plain(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        at += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, found in turns.items():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, role, text in found:
            signs = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not signs else "duplicate" if (role, text) in seen else "" if signs[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in found if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, last, path = heapq.heappop(heap)
            if (i, last) in done:
                continue
            done.add((i, last))
            if i == len(found) and last in ("", "a"):
                break

            def legal(initial, last=last):
                return last + initial in ("s", "u", "su", "ua", "au")

            for name in ("user", "assistant"):
                if legal(name[0]):
                    heapq.heappush(heap, (cost + 3, audit + "I", i, name[0], (*path, f"{name}:")))
            if i < len(found):
                _, role, text = found[i]
                heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, path))
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 * (faults[i] == "truncated")
                    if role and legal(role[0]):
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*path, f"{role}:{text}")))
                    for name in ("user", "assistant"):
                        if legal(name[0]):
                            heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, name[0], (*path, f"{name}:{text}")))
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(path).encode()).hexdigest())
    return out


def structure_rows():
    r = random.Random(1)
    rows = []
    for conv in [None, *range(80)]:
        for _ in range(r.randint(1, 14)):
            role = r.choice(["user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, r.choice([None, 0, 1, 2, 3, 4, 5, 6, 7, 8]), role, r.choice(["A.", "B!", "C", "D? ", "", None, " \t", "x\n", "é."])))
    for i in range(2500):  # one long conversation, with turns and texts that repeat
        rows.append((1000, i % 1200, r.choice(["user", "assistant"]), r.choice(["A.", f"hello {i}.", "z"])))
    return rows + [(1001, 1, "user", "a very long text " * 100_000 + ".")]


def structure(df):
    return structure_repair.structure_digest(df, structure_repair.faulted(structure_repair.damaged(df), "conv"))


def test_structure_repair_equals_brute_force(spark):
    rows = structure_rows()
    df = spark.createDataFrame([(*x, 1, "n") for x in rows], "conv_id long, turn long, role string, text string, n int, fault string")
    got = {x["conv_id"]: tuple(x)[1:] for x in structure(df).collect()}
    want = brute_structure(rows)
    assert {k for k in want if want[k] != got.get(k)} == set()
    assert len(got) == len(want)


def test_structure_of_dropped_and_no_rows(spark):
    dropped = [(i, 0, "user", "a.") for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(dropped, "conv_id long, turn long, role string, text string")
    assert dropped and {tuple(x)[1:] for x in structure(df).collect()} == {(0, 0, 0, 0, 0, 0, "", EMPTY)}
    assert structure(df.limit(0)).collect() == []


def test_repaired_turns_are_legal(spark):
    df = spark.createDataFrame(structure_rows(), "conv_id long, turn long, role string, text string")
    faults = structure_repair.faulted(df)
    turns = structure_repair.repaired_turns(faults, structure_repair.repair_plans(faults)).toPandas()
    for _, rows in turns.sort_values("seq").groupby("conv"):
        assert re.fullmatch("s?(ua)+", "".join(x[0] for x in rows["role"]))


def test_shared_suffixes_are_made_once(monkeypatch):
    """Of words that share a suffix only the rest is walked; few shapes come of any number of letters."""
    calls = []
    plain = structure_repair.node_before
    monkeypatch.setattr(structure_repair, "node_before", lambda a, b: calls.append(a) or plain(a, b))
    words = sorted(w[::-1] for w in ("suaua", "uaua", "xaua", "Oua"))
    list(structure_repair.automaton(iter(words)))
    assert len(calls) == len({w[:i] for w in words for i in range(1, len(w) + 1)})
    list(structure_repair.automaton("".join(random.Random(i).choices("suaoSUAOx", k=5000)) for i in range(3)))
    assert plain.cache_info().currsize < 2000


# toxicity

BAD = ["blarkson", "vornick", "quimpel", "strogan"]
SYLLABLES = ["ba", "ce", "di", "fo", "gu", "ha", "le", "jo", "ri", "mo", "ta", "né"]


def toxic_tables(spark, n=900):
    r = random.Random(2)
    docs, labels, truth = [], [], {}
    for i in range(n):
        words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 120))]
        truth[i] = int(r.random() < 0.25)
        for _ in range(r.randint(1, 3) * truth[i]):
            words.insert(r.randrange(len(words)), r.choice(BAD))
        docs.append((i, " ".join(words), "en", 0.5))
        labels.append((i, 1, truth[i]))
    docs += [(9000, None, "en", 0.5), (9001, "", "de", 0.1), (9001, "", "de", 0.1), (None, "ba ce", None, None), (9002, BAD[0] + " " + "ba " * 200_000, "x", 0.0)]
    labels += [(3, 0, truth[3]), (None, 1, 1), (5, 1, None), (123456, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        truth,
    )


@pytest.fixture(scope="module")
def toxic(spark):
    docs, labels, truth = toxic_tables(spark)
    return docs, labels, truth, toxicity.fit(docs, labels)


def test_toxicity_on_held_out_documents(toxic):
    docs, _, truth, model = toxic
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == docs.count()
    for x in rows:
        assert x["held_out"] == (zlib.crc32(str("" if x["doc_id"] is None else x["doc_id"]).encode()) % 3 == 1)
        assert 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7)
    held = [(x["predicted"], truth[x["doc_id"]]) for x in rows if x["held_out"] and x["doc_id"] in truth]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(x["predicted"] == 0 for x in rows if x["doc_id"] in (None, 9000, 9001))


def test_disguised_words_are_restored(toxic):
    model = toxic[3]
    decoder = toxicity.Decoder(model.costs)
    disguised = {
        "bl4rks0n": "blarkson", "b l a r k s o n": "blarkson", "v-o-r-n-i-c-k": "vornick", "vorrrrnick": "vornick",
        "qu1mpel": "quimpel", "$trogan": "strogan", "s.t.r.o.g.a.n": "strogan", "VORN!CK": "vornick",
    }
    for seen, meant in disguised.items():
        assert meant in decoder.words(f"ba ce {seen} di fo"), seen
        assert meant in decoder.restored(f"ba ce {seen} di fo").split(), seen
    plain = "ba ce difo haleri, né 10.0.0.1 ta!!"
    assert decoder.restored(plain).replace("!", "") == plain.replace("!", "")


def test_disguised_documents_are_found(spark, toxic):
    model = toxic[3]
    r = random.Random(6)
    signs = str.maketrans("oiae", "014" + "3")
    texts = []
    for i in range(80):
        word = r.choice(BAD)
        word = [word.translate(signs), " ".join(word), word[:2] + word[2] * 4 + word[3:]][i % 3]
        words = ["".join(r.choice(SYLLABLES) for _ in range(3)) for _ in range(20)]
        texts.append((i, " ".join([*words[:9], word, *words[9:]])))
    rows = toxicity.scored(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert np.mean([x["predicted"] for x in rows]) > 0.9
    clean = [(i, re.sub(r"\S*[^ a-zé]\S*", "", t)) for i, t in texts[:1]]
    assert toxicity.restored(spark.createDataFrame([*clean, (2, None)], "doc_id long, text string"), model).count() == 2


def test_viterbi_equals_all_paths():
    r = random.Random(3)
    costs = -np.log(np.random.default_rng(1).dirichlet(np.ones(toxicity.SYMBOLS), (toxicity.SYMBOLS, toxicity.SYMBOLS)))
    decoder = toxicity.Decoder(costs)

    def read(options):
        best = None
        def walk(i, a, b, cost, text):
            nonlocal best
            if i == len(options):
                best = min(x for x in (best, (cost + (costs[a][b][0] if b else 0), text)) if x)
                return
            for letter, more in options[i]:
                c = toxicity._SYMBOL.get(letter, 0)
                if letter == "" or (not c and not b):
                    walk(i + 1, a, b, cost + more, text)
                else:
                    walk(i + 1, b, c, cost + more + costs[a][b][c], text + letter)
        walk(0, 0, 0, 0.0, "")
        return best[1]

    for _ in range(60):
        span = "".join(r.choice("abst01$$ii") for _ in range(r.randint(1, 7)))
        assert decoder.viterbi(span) == read(toxicity.lattice(span, False))


def test_toxicity_without_labels_or_documents(spark):
    docs, labels, _ = toxic_tables(spark, 20)
    model = toxicity.fit(docs, labels.limit(0))
    assert {x["predicted"] for x in toxicity.scored(docs, model).collect()} == {0}
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []


def test_trigram_counts_equal_brute_force(spark):
    rows = [("Ab a",), (None,), ("",), ("é--ab",), ("×x",)]
    got = {x["code"]: x["n"] for x in toxicity.trigram_counts(spark.createDataFrame(rows, "text string")).collect()}
    want = Counter()
    for (text,) in rows:
        if text is not None:
            plain = re.sub(r" +", " ", f" {''.join(c if c in toxicity._SYMBOL else ' ' for c in text.lower())} ")
            codes = [toxicity._SYMBOL.get(c, 0) for c in plain]
            want.update((a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
    assert got == dict(want)
