"""Decontamination, fill-in-middle and the conversation trie against brute force, with every awkward row."""

import hashlib
import random
import re
import zlib

import pytest

from quillspark.llm import conversation_trie, decontaminate, fill_middle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df):
    for c in ("n", "form", "output", "c0", "text2", "n_hit", "spans", "items", "cleaned", "_made", "node", "key", "low"):
        df = df.withColumn(c, df[df.columns[0]])
    return df


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# 11


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def hits_brute(docs, items, length=10, coverage=1.0):
    """doc_id, words, spans, ids of each text by comparing all windows."""
    windows = []
    for own, text in items:
        words = words_of(text)
        n = min(length, max(1, -int(-len(words) * coverage // 1)))
        windows += [(own, words[i : i + n]) for i in range(len(words) - n + 1)] if words else []
    out = []
    for own, text in docs:
        words, hit, found = words_of(text), set(), set()
        for i in range(len(words)):
            for item, w in windows:
                if words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    found |= {str(item)} - {"None"}
        spans = [[i, i] for i in sorted(hit)]
        for k in range(len(spans) - 1, 0, -1):
            if spans[k][0] == spans[k - 1][1] + 1:
                spans[k - 1][1] = spans.pop(k)[1]
        out.append((own, len(words), len(hit), [tuple(s) for s in spans], sorted(found)))
    return sorted(out, key=repr)


def told_hits(out):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], [(s["first"], s["last"]) for s in r["spans"]], list(r["items"])) for r in out.collect()), key=repr)


def leaky(seed, n_docs=60, n_items=14):
    """Texts over few words, so that windows meet by chance too, with passages of items in some."""
    draw = random.Random(seed)
    some = ["a", "B", "c1", "é", "Ünï", "x", "yy", "中文"]
    text = lambda n: "".join(draw.choice(some) + draw.choice([" ", ", ", "\n", " - "]) for _ in range(n))
    items = [(i, text(draw.choice([1, 3, 5, 9, 10, 11, 25]))) for i in range(n_items)]
    items += [items[3], (3, "another text of an id"), (None, text(12)), (90, None), (91, " -!? "), (92, items[2][1].upper())]
    docs = [(i, text(draw.randint(0, 60)) + (draw.choice(items)[1] or "") + text(draw.randint(0, 9))) for i in range(n_docs)]
    return docs + [(None, items[0][1]), (7, docs[7][1]), (500, None), (501, ""), (502, "?!"), (503, text(9000) + items[6][1] + text(5))], items


@pytest.mark.parametrize("seed,part,piece", [(1, 1 << 21, 1 << 14), (2, 400, 12), (3, 150, 4)])
def test_decontamination_by_brute_force(spark, monkeypatch, seed, part, piece):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    docs, items = leaky(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(clashing(d), clashing(b))
    assert told_hits(out) == hits_brute(docs, items)
    assert "n_chars" not in out.columns and out.columns[:2] == ["doc_id", "text"] and out.columns[-6:] == ["n_words", "n_hit", "longest", "spans", "items", "cleaned"]
    for r in out.where("doc_id < 30").collect():
        words = words_of(r["text"])
        gone = {i for s in r["spans"] for i in range(s["first"], s["last"] + 1)}
        assert words_of(r["cleaned"]) == [w for i, w in enumerate(words) if i not in gone]
        assert gone or r["cleaned"] == r["text"]


def test_decontamination_limits(spark):
    docs, items = leaky(4, 30, 8)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(d, b, decontaminate.Limits(6, 0.5), clean=False)
    assert told_hits(out) == hits_brute(docs, items, 6, 0.5)
    assert decontaminate.decontaminate(d.limit(0), b).count() == 0
    none = decontaminate.decontaminate(d, b.limit(0))
    assert {(r["n_hit"], r["longest"], r["cleaned"]) for r in none.where("doc_id = 3").collect()} == {(0, 0, docs[3][1])} and none.count() == len(docs)


def test_automaton_tells_longest_matches(monkeypatch):
    monkeypatch.setattr(decontaminate, "STRETCH", 7)
    draw = random.Random(5)
    for _ in range(150):
        word = lambda: draw.choice([b"a", b"b", b"c"])
        items = [(str(i), b" ".join(word() for _ in range(draw.randint(1, 12))), draw.randint(1, 3)) for i in range(draw.randint(1, 5))]
        items = [(i, w, min(n, len(w.split()))) for i, w, n in items]
        known = decontaminate.Automaton(items)
        words = [word() for _ in range(25)]
        n, longest, _, found = known.scan(b" ".join(words))
        inside = lambda part: any(w.split()[i : i + len(part)] == part for _, w, _ in items for i in range(len(w.split())))
        assert n == 25 and longest == max(b - a for a in range(25) for b in range(a, 26) if b == a or inside(words[a:b]))
        assert found == {i for i, w, n in items if any(words[a : a + n] == w.split()[j : j + n] for a in range(25) for j in range(len(w.split()) - n + 1))}
        assert len(known.link) <= 2 * sum(len(w.split()) for _, w, _ in items) + 1


# 12

TEXTS = [None, "", " ", "one", " lead", "trail  \n", "a b  c\td\x0be", "has <P> in it", "<S>", "né ünï 中文  x", "<P <S < M>", "w " * 3000, "x" * 5000, "\x1c \x85 q"]


def middle_brute(own, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if own is None else own}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return own, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    return own, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "en", None, 1) for i in range(150)] + [(None, "no id here"), (7, "again of seven"), (7, "again of seven")]
    rows = [(*r, None, None, 1)[:5] for r in rows]
    docs = clashing(spark.createDataFrame(rows, DOCS).repartition(3))
    out = fill_middle.fill_in_middle(docs)
    want = sorted((middle_brute(r[0], r[1]) for r in rows), key=repr)
    assert rows_of(out, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == want
    assert {r[2] for r in want} == {"plain", "spm", "psm"}
    both = fill_middle.fill_in_middle(docs, digests=True)
    assert both.columns[-7:] == ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]
    for r in both.collect():
        assert (r["output_sha256"], r["restored_sha256"]) == tuple(hashlib.sha256(t.encode()).hexdigest() for t in (r["output"], r["text"] or ""))
    assert "output" not in fill_middle.fill_in_middle(docs.drop("output"), output=False, digests=True).columns
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_middles_come_back():
    draw = random.Random(3)
    for k in range(400):
        text = "".join(draw.choice(["<", "<P", "P>", "S>", "<S", ">", " ", "\n", "é", "word"]) for _ in range(draw.randint(1, 14)))
        _, form, _, _, output = fill_middle.transformed(str(k), text, fill_middle.Draw(draw.randint(0, 9), 100, 50))[0:5]
        assert fill_middle.restored(output, form) == text


# 13


def trie_brute(sequences):
    """sequences: id to a list of (role, text)."""
    members, ends = {}, {}
    for own, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(own)
        ends.setdefault(tuple(turns), []).append(own)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


def spliced_brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def chatter(seed, n=150, texts=("hi", "ja", "é", None)):
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(1000), n):
        for t in range(draw.choice([1, 1, 2, 3, 5, 8, 30])):
            rows.append((c, t if t else None, draw.choice(["user", "bot", None]) if t > 2 else "user", draw.choice(texts) if t < 3 else "same"))
    draw.shuffle(rows)
    return rows + [(None, 0, "user", "nowhere")]


@pytest.mark.parametrize("seed,sizes,parts", [(1, conversation_trie.Sizes(), 3), (2, conversation_trie.Sizes(900, 2, 64, 3), 5), (3, conversation_trie.Sizes(4000, 3, 2, 1), 1)])
def test_trie_by_brute_force(spark, seed, sizes, parts):
    rows = chatter(seed)
    turns = clashing(spark.createDataFrame(rows, CONVERSATIONS).repartition(parts))
    got = conversation_trie.prefix_trie(conversation_trie.spliced(conversation_trie.turn_sequences(turns)).repartition(parts), sizes)
    assert rows_of(got, *COLUMNS) == trie_brute(spliced_brute(rows))
    assert got.select("node").distinct().count() == got.count()


def test_trie_of_copies_of_one_conversation(spark):
    """All alike, a chain of them, none, and sequences without a turn."""
    talk = [("user", "a"), ("bot", "bb"), ("user", "c")]
    rows = [(c, t, *talk[t]) for c in range(400) for t in range(3)] + [(1000 + k, t, "user", f"deep {t}") for k in range(6) for t in range(10 * k + 1)]
    turns = conversation_trie.turn_sequences(spark.createDataFrame(rows, CONVERSATIONS).repartition(7))
    sequences = {c: talk for c in range(400)} | {1000 + k: [("user", f"deep {t}") for t in range(10 * k + 1)] for k in range(6)}
    sizes = conversation_trie.Sizes(3000, 2, 64, 9)
    assert rows_of(conversation_trie.prefix_trie(turns.repartition(7), sizes), *COLUMNS) == trie_brute(sequences)
    lone = conversation_trie.spliced(conversation_trie.turn_sequences(spark.createDataFrame([(7, 0, "user", "x")], CONVERSATIONS)))
    assert rows_of(conversation_trie.prefix_trie(lone), *COLUMNS) == trie_brute(spliced_brute([(7, 0, "user", "x")]))
    assert conversation_trie.prefix_trie(turns.limit(0)).count() == 0


def test_merge_compares_no_shared_turn_again(monkeypatch):
    """The merged rows are those of a plain sort, their LCPs right, and turns are compared only behind what is known to be shared."""
    draw, T, looked = random.Random(9), conversation_trie.TOKEN, []
    honest = conversation_trie.shared

    def counting(a, b, depth):
        got = honest(a, b, depth)
        looked.append(got - depth + 1)
        return got

    monkeypatch.setattr(conversation_trie, "shared", counting)
    token = lambda: bytes([draw.randint(0, 1)]) * T
    for k in range(60):
        rows = [(i, [token() for _ in range(draw.randint(0, 12))], []) for i in range(draw.randint(0, 50))]
        runs = [list(conversation_trie.sorted_runs(iter([(i, t, [1] * len(t)) for i, t, _ in rows[r :: 1 + k % 7]]), r, conversation_trie.Sizes(400))) for r in range(1 + k % 7)]
        split = {}
        for row in (r for run in runs for r in run):
            split.setdefault(row[0], []).append(list(row[2:]))
        looked.clear()
        got = list(conversation_trie.merged([iter(r) for r in split.values()]))
        assert [g[0][0] for g in got] == sorted(r[0] for run in split.values() for r in run)
        assert sorted(i for g in got for i in g[0][5]) == [i for i, *_ in rows]
        before = b""
        for (key, *_), lcp in got:
            assert lcp == honest(before, key, 0)
            before = key
        # each turn is passed once, besides one look for each game that a row plays
        assert sum(looked) <= sum(len(g[0][0]) // T for g in got) + len(got) * (len(split).bit_length() + 1)
