"""Collocations, fingerprint groups and conversation repair against brute force and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tracklake.llm import collocations as C
from tracklake.llm import conversation_repair as R
from tracklake.llm import vp_tree as V
from tracklake.llm._lookup import lookup


def phrases(rows, least, top=2000):
    """The contract, one phrase at a time."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(4, len(w) - i) + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    cover = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                cover[lang, w[i : i + k]] = max(cover[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in found.items():
        if 100 * cover[lang, w] >= 80 * a:
            continue
        s, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    words = ["der", "Hund", "läuft", "ÄB", "x", "yy", "日本", "of", "the", "run-away"]
    rows = []
    for i in range(150):
        t = "".join(rnd.choice(words) + rnd.choice((" ", " ", "\t", "  ", ". ", ",", "\n", "\x0b!", " ")) for _ in range(rnd.randrange(40)))
        rows.append((i, t, rnd.choice(("en", "de", None))))
    rows += [(None, rows[1][1], None), (None, None, None), (7, "", "en"), (8, " .,;\n\t ", "fr"), (9, "one", "xx"), (9, "the of " * 30_000, "en")] + [rows[2]] * 20
    return rows


def test_phrases_against_brute_force(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumns({c: F.lit("clash") for c in ("phrase", "f", "a", "k", "size", "piece", "n", "salt", "w", "slot")}).repartition(5)
    for top in (2000, 7):
        got = C.collocations(docs, least=12, top=top)
        assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == phrases([(lang, t) for _, t, lang in texts], 12, top)
    assert C.collocations(docs.limit(0)).count() == 0


def test_phrase_counts_of_blocks_and_spills(texts, monkeypatch, tmp_path):
    """Blocks of a few bytes give the same totals as one; duckdb sums more groups than its memory holds."""
    pieces = Counter()
    batch = pa.RecordBatch.from_pylist([{"lang": x or "und", "text": t} for _, t, x in texts], pa.schema([("lang", pa.string()), ("text", pa.string())]))
    for part in C._split(iter([batch])):
        pieces.update((r["lang"], r["piece"]) for r in part.to_pylist())
    table = pa.RecordBatch.from_pylist([{"lang": x, "piece": p, "n": n} for (x, p), n in pieces.items()])
    totals = []
    for size in (4 << 20, 64):
        monkeypatch.setattr(C, "BLOCK_BYTES", size)
        sums = Counter()
        for part in C._counted((1, 2, 3, 4))(iter([table])):
            for r in part.to_pylist():
                sums[r["lang"], r["phrase"], r["size"]] += r["f"]
        totals.append(sums)
    assert totals[0] == totals[1]
    marks = C._marks(pa.array([b"en"] * 3000), pa.array([b"a b%d" % i for i in range(3000)]))
    known = np.zeros(1 << 13, np.uint8)
    np.bitwise_or.at(known, (C._bits(marks[:1000], 1 << 16) >> np.uint64(3)).astype(int), np.uint8(1) << (C._bits(marks[:1000], 1 << 16) & np.uint64(7)).astype(np.uint8))
    assert C._may_hold(known, marks[:1000]).all() and C._may_hold(known, marks[1000:]).mean() < 0.02
    monkeypatch.setenv("SPARK_EXECUTOR_DIRS", str(tmp_path))
    n = 400_000
    make = lambda k: pa.RecordBatch.from_arrays([pa.array(["en"] * n), pa.array([f"a phrase of some length {(i * 7919 + k) % n}" for i in range(n)]), pa.array(np.full(n, 3, np.int32)), pa.array(np.full(n, 10))], names=["lang", "phrase", "size", "f"])
    out = list(C._summed(30, "32MB")(make(k) for k in range(3)))
    assert sum(b.num_rows for b in out) == n and {x for b in out for x in b.column("f").unique().to_pylist()} == {30} and not list(tmp_path.iterdir())


def test_lookup_of_hot_and_null_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i}" if i % 7 else None) for i in range(5000)], "i long, k string")
    table = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 5000, 2)], "k string, v long")
    got, _ = lookup(rows, table, ["k"])
    want = rows.join(table, "k", "left")
    assert sorted(map(str, got.select("i", "k", "v").collect())) == sorted(map(str, want.select("i", "k", "v").collect()))


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(marks):
    """The smallest mark that each reaches, from all pairs."""
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(marks, 2):
        if (a ^ b).bit_count() <= V.DISTANCE:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {m: find(m) for m in marks}


@pytest.fixture(scope="module")
def marks():
    """Far ones, chains, and a dense ball whose members cannot be told apart by most radii."""
    rnd = random.Random(4)
    found = {rnd.getrandbits(64) for _ in range(500)} | {0, (1 << 64) - 1}
    for seed in list(found)[:60]:
        for _ in range(rnd.randrange(6)):
            seed ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
            found.add(seed)
    ball = rnd.getrandbits(64)
    found |= {ball ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    return sorted(found)


def test_tree_reaches_every_link(marks, monkeypatch):
    own = np.array(marks, np.uint64)
    tree = V.Tree()
    assert tree.grow(0, own[::3], 12)
    home_row, home = tree.reached(own, 0)
    assert sorted(home_row) == list(range(len(own)))
    full = int(np.bincount(home).argmax())
    assert tree.grow(full, own[home_row[home == full]], 8)  # split again: the shard's number stays with one part
    home_row, home = tree.reached(own, 0)
    assert sorted(home_row) == list(range(len(own))) and tree.shards > 20
    rows, shards = tree.reached(own, V.DISTANCE)
    monkeypatch.setattr(V, "BLOCK", 8)
    edges = []
    for s in range(tree.shards):
        a, b = V.forest(own[home_row[home == s]], own[rows[shards == s]])
        assert len(a) < max(1, (shards == s).sum())  # a forest
        edges += list(zip(a.tolist(), b.tolist(), strict=True))
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {m: find(m) for m in marks} == linked(marks)


def test_shards_refit_on_all_marks(spark, marks):
    table = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "mark long")
    tree = V.fitted(table, shard=20, sample=40)  # the first sample cannot fill shards of 20
    sizes = [r["count"] for r in V.dealt(table, tree, 0).groupBy("shard").count().collect()]
    assert sum(sizes) == len(marks) and len(sizes) > 10
    ball = max(sizes)
    assert ball < len(marks) // 3


def test_fingerprint_groups_against_all_pairs(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(70):
        base = [rnd.choice(words) for _ in range(rnd.choice((1, 2, 3, 9, 120, 900)))]
        rows.append((3 * i, " ".join(base)))
        for j in range(rnd.randrange(3)):
            base[rnd.randrange(len(base))] = rnd.choice(words)
            rows.append((3 * i + j + 1, "\n".join(base).upper()))
    rows += [(None, rows[4][1]), (None, None), (1000, ""), (1001, " \t\x0b "), (1002, "ÄÖ é"), rows[0], rows[0], (None, "no such other text at all here"), (1003, "z" * 200_000 + " b" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("mark", "component", "node", "shard", "least", "home", "a", "b")})
    got = V.simhash_groups(docs, shard=16).collect()
    mark = {t: plain_fingerprint(t) for _, t in rows}
    reach = linked(sorted(set(mark.values())))
    name = {}
    for i, t in rows:
        if i is not None:
            name[reach[mark[t]]] = min(i, name.get(reach[mark[t]], i))
    want = sorted(repr((i, mark[t], name.get(reach[mark[t]]))) for i, t in rows)
    assert sorted(repr((r.doc_id, r.mark % (1 << 64), r.component_id)) for r in got) == want
    assert len(set(name.values())) < len({i for i, _ in rows}) - 10
    assert V.simhash_groups(docs.limit(0)).count() == 0


def every_audit(rows, start, goal, most=3):
    """The least (cost, audit) over all edits with at most ``most`` insertions."""
    best = None

    def go(i, state, cost, audit, left):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and state == goal and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if left:
            go(i, R.ANSWER[state], cost + 3, audit + "I", left - 1)
        if i == len(rows):
            return
        c, fault = rows[i]
        go(i + 1, state, cost + 4, audit + "D", left)
        if fault in (0, 3):
            more = 3 if fault == 3 else 0
            go(i + 1, R.ANSWER[state], cost + more + 3, audit + "R", left)
            if state in R.AFTER.get(c, {}):
                go(i + 1, R.AFTER[c][state], cost + more, audit + "K", left)

    go(0, start, 0, "", most)
    return best


def test_search_against_all_edits():
    rnd = random.Random(1)
    for _ in range(150):
        rows = [(rnd.choice("suuaat"), rnd.choice((0, 0, 0, 1, 2, 3))) for _ in range(rnd.randrange(6))]
        for start in range(4):
            found = R.cheapest(rows, start, {0, 1, 2, 3})
            for goal in range(4):
                assert found.get(goal) == every_audit(rows, start, goal), (rows, start, goal)
    for _ in range(60):  # runs composed give what the whole gives
        rows = [(rnd.choice("suuaa"), rnd.choice((0, 0, 0, 1, 2, 3))) for _ in range(40)]
        best, at = {0: (0, "")}, 0
        while at < len(rows):
            n = rnd.randrange(1, 12)
            best = R.composed(best, {(a, b): x for a in range(4) for b, x in R.cheapest(rows[at : at + n], a, {0, 1, 2, 3}).items()})
            at += n
        assert best == R.cheapest(rows, 0, {0, 1, 2, 3})


def mended(rows):
    """One conversation as the contract says, from its rows before damage."""
    hurt = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        r = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if r:
            row = (turn, "user" if r == 4 else role, "" if r == 1 else re.sub("[.!?]", "", text) if r == 2 else text)
            hurt += [row] * (2 if r == 3 else 1)
    hurt.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in hurt:
        tip = text.rstrip(R.SPACE)
        faults.append(1 if not tip else 2 if (role, text) in seen else 3 if tip[-1] not in ".!?" else 0)
        seen.add((role, text))
    ends = R.cheapest([(role[:1], f) for (_, role, _), f in zip(hurt, faults, strict=True)], 0, {0, 3})
    cost, audit = min(ends.values())
    turns = {t for t, *_ in hurt if t is not None}
    c = [role[:1] for _, role, _ in hurt]
    text = "\n".join(f"{a}:{b}" for a, b in R.applied(audit, iter([x[1:] for x in hurt])))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count(1), faults.count(2), faults.count(3), sum(x + y not in ("su", "ua", "au") for x, y in zip(c, c[1:], strict=False)), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def test_repair_of_odd_and_long_conversations(spark):
    rnd = random.Random(2)
    say = lambda: rnd.choice(("Fine.", "no end", "", None, " \t\x0b", "Ja! ", "so?\n", "Ende .", "日本。", "a" * 500 + "."))
    role = lambda: rnd.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None))
    rows = [(conv, turn if rnd.random() > 0.05 else None, role(), say()) for conv in range(60) for turn in range(rnd.randrange(1, 9))]
    rows += [(900, t, role(), f"{say() or ''}{t}.") for t in range(1500)]  # six runs
    rows += [(None, t, role(), say()) for t in range(5)] + [(901, 1, "user", "Hi."), (901, 1, "user", "Hi."), (901, 1, "assistant", "Ho.")] + [(902, None, None, None)] * 3
    rows += [(c, 0, "user", "Gone.") for c in range(2000, 2100)]  # some of these lose their only row
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("digest", "copy", "kind", "audit", "fault", "initial", "run")}).repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in R.repaired(table).collect()}
    want = {c: mended([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values() and len(got[900][6]) > 1400
    assert R.repaired(table.limit(0)).count() == 0
