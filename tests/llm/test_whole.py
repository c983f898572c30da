"""What the operators must not leave out, against brute force."""

import random

import numpy as np

from tracklake.llm.line_dedup import edit_distance, fuzzy_lines
from tracklake.llm.near_dedup import near_duplicates


def grouped(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    out = {}
    for x in nodes:
        out.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in out.values()}


def test_banded_edit_distance():
    import pyarrow as pa

    from tracklake.llm.line_dedup import similar

    rnd = random.Random(6)
    pairs = []
    for _ in range(400):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(1, 30))]
        b = [x for x in a if rnd.random() > 0.1]
        b = [rnd.randrange(4) if rnd.random() < 0.1 else x for x in b] + [rnd.randrange(4)] * rnd.randrange(3)
        pairs.append((a, b))
    pairs.append((list(range(900)), list(range(50, 950))))
    a, b = (pa.array([np.array(p[i], np.uint32).tobytes() for p in pairs], pa.binary()) for i in (0, 1))
    for least in (0.5, 0.8, 0.9):
        want = []
        for x, y in pairs:
            most = int((1 - least) * max(len(x), len(y)) + 1e-9)
            want.append(edit_distance(np.array(x), np.array(y), most) <= most)
        assert similar(a, b, least).tolist() == want


def test_line_groups_against_all_pairs(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    lines = []
    for size in (5, 6, 8, 10, 14, 20, 27, 40, 80, 150, 300):
        for turn in range(8):
            own = [rnd.choice(vocabulary) for _ in range(size)]
            one, most, longer = list(own), list(own), list(own)
            one[rnd.randrange(size)] = "other"
            for k in rnd.sample(range(size), size // 5):  # similarity 0.8
                most[k] = f"new{size}x{turn}x{k}" if turn % 2 else rnd.choice(vocabulary)
            for _ in range(max(1, size // 8)):
                longer.insert(rnd.randrange(size), rnd.choice(vocabulary))
            lines += [own, one, most, longer]
    lines += [["a"] * 8, ["a"] * 9, ["a", "b"] * 5, ["a", "b"] * 5 + ["b"]]
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    classes = sorted({tuple(x) for x in lines})
    number = {w: k for k, w in enumerate(sorted({w for x in classes for w in x}))}
    coded = {x: np.array([number[w] for w in x]) for x in classes}
    links = [(x, y) for k, x in enumerate(classes) for y in classes[k + 1 :] if abs(len(x) - len(y)) <= max(len(x), len(y)) // 5 and edit_distance(coded[x], coded[y], 99) <= max(len(x), len(y)) // 5]
    judged = fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(judged) == len(lines)
    group = {tuple(lines[r.doc_id]): r.group for r in judged}
    met = sum(group[x] == group[y] for x, y in links)
    assert len(lines) > 300 and met >= 0.97 * len(links)
    found = {}
    for x in classes:
        found.setdefault(group[x], set()).add(x)
    whole = {x: g for g in grouped(classes, links) for x in g}
    assert all(g <= whole[next(iter(g))] for g in found.values())  # no pair is joined that all pairs would not join
    assert sum(r.kept for r in judged) == len(found)


def test_words_are_counted_in_all_documents(spark, monkeypatch):
    from collections import Counter

    import pyarrow as pa

    from tracklake.llm import line_dedup
    from tracklake.llm._text import hashes

    rnd = random.Random(9)
    texts = [None, "", *(" ".join(f"w{int(rnd.paretovariate(0.7))}" for _ in range(60)) + "\nW1 w2" for _ in range(300))]
    want = Counter(w for t in texts if t for w in t.lower().split())
    code = dict(zip(want, hashes(pa.array([w.encode() for w in want], pa.binary())).tolist(), strict=True))
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    word, n = line_dedup.listed_words(docs)
    assert dict(zip(word.tolist(), n.tolist(), strict=True)) == {code[w]: k for w, k in want.items() if k > 16} and (np.diff(word) > 0).all()
    few = {code[w]: k for w, k in want.items() if k > 5 and k > sum(x for x in want.values() if x > 5) // 20}
    word, n = line_dedup.listed_words(docs, seldom=5, most=20)
    assert 2 < len(few) < 20 and dict(zip(word.tolist(), n.tolist(), strict=True)) == few
    none = line_dedup.listed_words(docs.limit(0))
    assert len(none[0]) == len(none[1]) == 0
    monkeypatch.setattr(line_dedup, "HELD", 40)
    monkeypatch.setattr(line_dedup, "pieces", lambda batches, limit: (b.slice(k, 7) for b in batches for k in range(0, b.num_rows, 7)))
    got = Counter()
    parts = list(line_dedup._counted(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    for part in parts:
        for own, times in zip(part.column("words").to_pylist(), part.column("counts").to_pylist(), strict=True):
            got.update(dict(zip(np.frombuffer(own, np.uint64).tolist(), np.frombuffer(times, np.int64).tolist(), strict=True)))
    assert len(parts) > 1 and got == {code[w]: k for w, k in want.items()}


def test_pipeline_counts_the_words_of_all_documents(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    from tracklake.llm import line_dedup

    rows = [(i, f"common words here own{i}", "en", "a", 9) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    told, listed = [], line_dedup.listed_words
    monkeypatch.setattr(line_dedup, "listed_words", lambda docs: told.append(listed(docs)) or told[0])
    assert corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).count() == 40
    assert told[0][1].tolist() == [40, 40, 40]


def test_lines_on_odd_rows(spark):
    from pyspark.sql import functions as F

    from tracklake.llm.line_dedup import dropped_lines, without_lines

    text = "one two three four five six\n\nalone in here"
    rows = [(None, text), (None, "one two three four five seven"), (3, text), (3, text), (4, None), (5, ""), (6, "long " * 60000), (7, "long " * 60001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("dropped", "own", "line", "group", "kept", "lines"):
        df = df.withColumn(name, F.lit("x"))
    judged = fuzzy_lines(df)
    assert sorted((r.doc_id or 0, r.line, r.kept) for r in judged.collect()) == [(0, 0, False), (0, 0, False), (0, 2, False), (3, 0, True), (3, 0, True), (3, 2, True), (3, 2, True), (6, 0, True), (7, 0, False)]
    out = without_lines(df, dropped_lines(judged))
    assert out.columns == df.columns
    left = sorted((r.doc_id or 0, -1 if r.text is None else len(r.text)) for r in out.collect())
    assert left == [(0, 0), (0, 0), (3, len(text)), (3, len(text)), (4, -1), (5, 0), (6, 300000), (7, 0)]
    assert fuzzy_lines(df.limit(0)).count() == 0 and without_lines(df.limit(0), dropped_lines(judged)).count() == 0


def test_telling_terms_of_a_copied_text(spark):
    from tracklake.llm.sanitise import find_private

    texts = [f"mail zebulon now jane@corp.org number {i} word{i}" for i in range(4)] + [f"plain words number {i} now mail word{i}" for i in range(4, 60)]
    rows = [*enumerate(texts), *((100 + i, texts[0]) for i in range(300))]
    got = find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all([s.value for s in r.term] == (["zebulon"] if r.doc_id < 4 or r.doc_id >= 100 else []) for r in got)


def test_links_in_a_bucket_of_unlike_pairs(spark):
    from tracklake.llm._text import hashes, shingles

    import pyarrow as pa

    names = [f"w{i}" for i in range(3000)]
    lowest = min(names, key=lambda w: shingles(hashes(pa.array([w.encode()])), np.array([0, 1]), 1)[0][0])
    rest = [w for w in names if w != lowest]
    rows = []
    for i in range(40):  # forty pairs of copies, unlike one another but for the word that puts all in one bucket
        own = [lowest, *rest[20 * i : 20 * i + 20]]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own, "end"]))]
    random.Random(1).shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=1, bands=1, rows=1).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got)


def scanned_rows(monkeypatch):
    """Rows that all bucket scans make, added up in a list."""
    from tracklake.llm import _links

    made, plain = [], _links.materialize

    def counted(df, tag, *rest):
        out = plain(df, tag, *rest)
        if tag == "scanned":
            made.append(out.count())
        return out

    monkeypatch.setattr(_links, "materialize", counted)
    return made


def test_unlinked_near_copies_do_not_leave_their_buckets(spark, monkeypatch):
    rnd = random.Random(12)
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join(f"n{rnd.random()}" if i in cut else w for i, w in enumerate(base)) for cut in (set(rnd.sample(range(120), rnd.randrange(3, 6))) for _ in range(400))]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    links = [(i, j) for i in range(400) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    made = scanned_rows(monkeypatch)
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {}
    for r in got:
        found.setdefault(r.component_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in found.values()} == grouped(range(400), links) and len(found) > 10
    print("near copies, rows scanned", made)
    assert sum(made[2:]) <= 100


def test_unlinked_near_lines_do_not_leave_their_buckets(spark, monkeypatch):
    rnd = random.Random(13)
    base = [f"b{i}" for i in range(40)]
    lines = [[f"n{rnd.random()}" if i in cut else w for i, w in enumerate(base)] for cut in (set(rnd.sample(range(6, 40), 6)) for _ in range(300))]
    links = [(i, j) for i in range(300) for j in range(i) if sum(x != y for x, y in zip(lines[i], lines[j], strict=True)) <= 8]
    made = scanned_rows(monkeypatch)
    got = fuzzy_lines(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")).collect()
    found = {}
    for r in got:
        found.setdefault(r.group, set()).add(r.doc_id)
    assert {frozenset(g) for g in found.values()} == grouped(range(300), links) and len(found) > 10
    print("near lines, rows scanned", made)
    assert sum(made[1:]) <= 4 * 300


def test_pipeline_with_null_columns(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(8)

    def text(i):
        return " ".join(f"w{rnd.randrange(5000)}x{i}" for _ in range(40))

    own = [text(i) for i in range(40)]
    rows = [(i if i % 4 else None, t, None, None, None) for i, t in enumerate(own)]
    rows += [(None, own[4] + " end", None, None, None), (None, own[5] + " end", None, None, None), (77, None, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (500, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    near = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, str(tmp_path)).collect()
    # of a text and its near copy, both without id, one stays; a near copy without id of one with an id goes
    assert len(near) == 42 and sum(r.doc_id is None for r in near) == 11 and own[5] in {r.text for r in near}
    assert sum(r.text in (own[4], own[4] + " end") for r in near) == 1 and own[5] + " end" not in {r.text for r in near}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.doc_id is None and r.n_tokens > 2 for r in out) == 10 and {r.doc_id for r in out} >= {i for i in range(40) if i % 4}


def test_search_in_repeated_rows(spark):
    from tracklake.llm.rp_forest import forest_neighbours
    from tracklake.llm.va_file import exact_top_k

    v = np.floor(np.random.RandomState(2).standard_normal((200, 8)) * 8)
    once = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, vector array<double>")
    thrice = once.unionAll(once).unionAll(once).repartition(1)
    asked = once.where("vec_id % 40 = 0")
    for found in (exact_top_k(thrice, asked), forest_neighbours(thrice, asked, leaf_rows=50, recall=1.0, probes=200)):
        got = {}
        for r in found.orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        for q in range(0, 200, 40):
            ids = np.delete(np.arange(200), q)
            assert got[q] == ids[np.lexsort((ids, -(v[ids] @ v[q])))][:20].tolist()


def test_edits_are_counted_only_where_words_allow_them(monkeypatch):
    import pyarrow as pa

    from tracklake.llm import line_dedup

    rnd = random.Random(14)
    pairs, want = [], []
    for size in (5, 12, 40, 130, 500):
        for turn in range(60):
            a = [rnd.randrange(1 << 30) for _ in range(size)]
            cut = size // 5 + turn % 2 * (size // 4 + 1)  # too many in every other pair
            b = [*a[cut:], *(rnd.randrange(1 << 31, 1 << 32) for _ in range(cut))] if turn % 4 < 2 else [rnd.randrange(1 << 31, 1 << 32) if i < cut else x for i, x in enumerate(a)]
            pairs.append((a, b) if turn % 3 else (b, a))
            want.append(edit_distance(np.array(a), np.array(b), size) <= size // 5)
    banded, single, judged = line_dedup._banded, line_dedup.edit_distance, []
    monkeypatch.setattr(line_dedup, "_banded", lambda a, *rest: judged.append(len(a)) or banded(a, *rest))
    monkeypatch.setattr(line_dedup, "edit_distance", lambda *rest: judged.append(1) or single(*rest))
    a, b = (pa.array([np.array(p[i], np.uint32).tobytes() for p in pairs], pa.binary()) for i in (0, 1))
    assert line_dedup.similar(a, b, 0.8).tolist() == want and 0 < sum(want) < 150
    assert sum(judged) <= 160  # of 300 pairs, 150 have too few words in common
    monkeypatch.setattr(line_dedup, "MOST_BINS", 4)
    assert line_dedup.similar(a, b, 0.8).tolist() == want
    assert line_dedup.similar(a[:0], b[:0], 0.8).tolist() == []


def test_simhash_of_many_lines_is_that_of_each():
    from tracklake.llm.line_dedup import simhash

    rnd = np.random.default_rng(15)
    own = rnd.integers(0, 1 << 63, 400).astype(np.uint64)
    size = np.append(rnd.integers(1, 30, 700), [256, 600, 1])
    ids, at = rnd.integers(0, 400, size.sum()), np.concatenate([[0], np.cumsum(size)])
    bits = (own[ids][:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(np.int64)
    for k, code in enumerate(simhash(ids, own, at).tolist()):
        twice = 2 * bits[at[k] : at[k + 1]].sum(axis=0)
        assert code == sum(1 << i for i in range(64) if twice[i] > size[k] or twice[i] == size[k] and i % 2)
