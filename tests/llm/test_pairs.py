"""Repeated strings, near-duplicates, embeddings and the pipeline against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_texts import brute_lines, brute_targets, tokenizer
from weft.llm import chosen_path, ego_join, mixing, perm_index, suffix_index
from weft.llm.common import by_class, lowest_by_hash, table
from weft.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_removed(rows):
    """(n_bytes, n_removed, n_spans, sha256) by id."""
    seen, out = {}, {}
    texts = sorted((i, (t or "").encode()) for i, t in rows if i is not None)
    for i, b in texts:
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], i)
    for i, b in texts:
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < i:
                cover[k : k + 50] = True
        spans = int((np.diff(cover.astype(np.int8), prepend=0) == 1).sum())
        out[i] = (len(b), int(cover.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~cover].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize(("hot", "broadcast"), [(suffix_index.HOT, True), (2, False)])
def test_suffix_dedup_equals_brute_force(spark, awkward, nothing, hot, broadcast, monkeypatch):
    if not broadcast:  # the way beyond the size checks
        monkeypatch.setattr(suffix_index, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(suffix_index, "BROADCAST_IDS", -1)
    docs = table(spark, SF, "documents").select("doc_id", "text")
    passage = "some passage of well over fifty bytes that many documents happen to share, word by word"
    more = [(10_000 + i, f"{'ab ' * i}{passage[i % 3:]}{i}") for i in range(30)]
    more += [(20_000, "x" * 400), (20_001, "y" + "x" * 90), (20_002, passage[:50]), (20_003, passage[:49]), (20_004, "é" * 60)]
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    expected = brute_removed([tuple(r) for r in docs.collect()])
    for r in suffix_index.remove_repeats(docs, hot=hot).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id
    got = suffix_index.remove_repeats(awkward).collect()
    expected = brute_removed([(r.doc_id, r.text) for r in awkward.collect()])
    assert len(got) == 13 and all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id] for r in got if r.doc_id is not None)
    assert suffix_index.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_suffix_dedup_of_ids_with_several_texts(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(suffix_index, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(suffix_index, "BROADCAST_IDS", -1)
    rng = np.random.default_rng(6)
    a, b, c, d = ("".join(rng.choice(list("abcdefgh "), 300)) for _ in range(4))
    # id 2: a copy of id 1's text, a text of its own and a short one; ids 3 and 4: strings of that text, two texts with a common string
    rows = [(1, a), (2, a), (2, b), (2, "short"), (2, None), (3, "x" + b[40:200]), (3, c[:100] + b[:60]), (3, c), (3, c), (4, d + c[20:90]), (4, d), (5, d[100:]), (None, a)]
    expected = []
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        cover, known = np.zeros(len(raw), bool), {s.encode()[x : x + 50] for j, s in rows if j and i and j < i and s for x in range(len(s) - 49)}
        for x in range(len(raw) - 49):
            if raw[x : x + 50] in known:
                cover[x : x + 50] = True
        expected.append((i, len(raw), int(cover.sum()), int((np.diff(cover.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~cover].tobytes()).hexdigest()))
    got = suffix_index.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_suffix_family_keeps_geometric_levels():
    rng = np.random.default_rng(4)
    family, least = suffix_index.SuffixFamily(), {}
    for batch in range(30):
        text = rng.choice(np.frombuffer(b"ab", np.uint8), 80)
        if batch % 3:
            text[:60] = [*b"abcdef" * 10]
        text = np.concatenate([np.frombuffer(b"\0" * (batch % 2), np.uint8), text])
        places = rng.permutation(len(text) - 49)
        known = family.add(text, places, np.full(len(places), batch))
        for place, id_ in zip(places, known, strict=True):
            assert id_ == least.setdefault(text[place : place + 50].tobytes(), batch)
        sizes = [len(level.ids) for level in family.levels]
        assert all(x > 2 * y for x, y in zip(sizes, sizes[1:], strict=False)) and sum(sizes) <= len(least) * 2
        for level in family.levels:
            strings = [level.text[k : k + 50].tobytes() for k in level.places]
            assert strings == sorted(set(strings)) and [least[x] for x in strings] <= list(level.ids)
    assert len(family.add(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def shingles(text):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def similar(a, b):
    common = len(a & b)
    return common > 0 and common * 5 >= 4 * len(a | b)


def linked_rows(n, linked):
    """(links, index of the least row reachable) of rows 0 to n - 1, in order."""
    links, group = [0] * n, list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                links[a] += 1
                links[b] += 1
                old, new = max(group[a], group[b]), min(group[a], group[b])
                if old != new:
                    group = [new if g == old else g for g in group]
    return links, group


def brute_groups(rows):
    """(links, group) by id, for rows of distinct ids."""
    ids, sets = zip(*sorted((i, shingles(t)) for i, t in rows), strict=True)
    links, group = linked_rows(len(ids), lambda a, b: similar(sets[a], sets[b]))
    return dict(zip(ids, links, strict=True)), {i: ids[g] for i, g in zip(ids, group, strict=True)}


def near_copies(n, groups, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    rows = []
    for g in range(groups):
        base = list(rng.choice(vocabulary, 120))
        for k in range(n):
            words = base.copy()
            if k % 3:
                words[int(rng.integers(120))] = f"edit{k}"
            rows.append((g * 1000 + k, " ".join(words)))
    return rows


def test_chosen_path_equals_brute_force(spark, awkward, nothing, monkeypatch):
    rows = [(r.doc_id + 100_000, r.text) for r in table(spark, SF, "documents").collect()] + near_copies(90, 2, 1) + near_copies(3, 20, 2)[60 - 12 :]
    rows = list({i: (i, t) for i, t in rows}.values())
    links, group = brute_groups(rows)
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.9999).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.group_id, r.kept) == (links[r.doc_id], group[r.doc_id], group[r.doc_id] == r.doc_id), r
    got = {r.doc_id: r for r in chosen_path.near_duplicates(awkward).collect()}
    assert (got[4].n_links, got[5].class_id, got[5].kept) == (1, 4, False) and got[10].group_id == 9
    assert (got[1].n_links, got[2].n_links, got[3].n_links, got[1].kept, got[None].kept, got[11].n_links) == (0, 0, 0, True, True, 1)
    assert chosen_path.near_duplicates(nothing).count() == 0
    monkeypatch.setattr(chosen_path, "BROADCAST_IDS", -1)  # the way beyond the size check
    kept = chosen_path.one_of_each_group(awkward)
    assert kept.columns == awkward.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 11]


def test_chosen_path_of_ids_with_several_texts(spark):
    text = lambda k, edit="": " ".join([f"t{k}w{i}" for i in range(60)] + [edit])
    rows = [(1, text(1)), (1, text(2)), (2, text(1, "x")), (3, text(2, "y")), (3, text(2, "y")), (4, text(3)), (4, text(1, "z")), (5, ""), (6, ""), (7, None), (8, None), (9, " "), (1, text(1))]
    rows = sorted(rows, key=lambda r: r[0])
    sets = [shingles(t) if shingles(t) else t for _, t in rows]
    linked = lambda a, b: similar(sets[a], sets[b]) if isinstance(sets[a], frozenset) and isinstance(sets[b], frozenset) else sets[a] is not None and sets[a] == sets[b]
    links, group = linked_rows(len(rows), linked)
    expected = sorted((i, n, rows[g][0]) for (i, _), n, g in zip(rows, links, group, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit("x")).withColumn("head", F.lit(1))
    got = chosen_path.near_duplicates(df, recall=0.9999).collect()
    assert sorted((r.doc_id, r.n_links, r.group_id) for r in got) == expected
    kept = chosen_path.one_of_each_group(df)
    assert kept.columns == df.columns and sorted((r.doc_id, r.text or "") for r in kept.collect())[2:] == [(4, text(3)), (5, ""), (7, ""), (8, ""), (9, " ")]
    assert sorted(r.text[:3] for r in kept.where("doc_id = 1").collect()) == ["t1w", "t2w"]


def test_chosen_path_finds_what_it_promises(spark, monkeypatch):
    """At the recall of the query, in buckets that are split to the last depth."""
    monkeypatch.setattr(chosen_path, "LIMIT", 4)
    rng = np.random.default_rng(3)
    common = [f"c{k}" for k in range(300)]
    rows = []
    for g in range(300):  # pairs of a similarity of just 0.8 and more, with shared passages that make buckets large
        base = [f"g{g}w{k}" for k in range(90)] + common[:60]
        near = base.copy()
        for at in rng.choice([12, 30, 48], int(rng.integers(1, 4)), replace=False):
            near[at] = "edit"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(near))]
    links, _ = brute_groups(rows)
    assert sum(links.values()) == 600
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_links <= links[r.doc_id] for r in got) and sum(r.n_links for r in got) >= 0.99 * 600


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (5, 5), (400, 399)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == 100 and got[400] == 399
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed, n=150):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 5, 16))
    x = np.repeat(centre, 5, 0) + rng.normal(size=(n, 16)) * np.linspace(0.05, 0.4, n)[:, None]
    rows = [(i, [float(v) for v in np.float32(x[i])], [0, 1, None][i % 3] if i % 10 == 9 else (i // 5) % 2) for i in range(n)]
    inf, nan = float("inf"), float("nan")
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [nan] * 16, 0), (1003, [inf] + [1.0] * 15, 0), (1004, [None] + [1.0] * 15, 0), (1005, [], 0)]
    rows += [(1100 + i, rows[3][1], 0) for i in range(20)] + [(1200, [1.0, 2.0], 0), (1250, [1.0, 2.0], 0), (None, rows[3][1], 0), (1300, rows[3][1], None)]
    return rows


def unit(v):
    if v is None or not v or any(a is None or not np.isfinite(a) for a in v) or not any(v):
        return None
    v = np.array(v, float)
    return v / np.linalg.norm(v)


@pytest.mark.parametrize("block", [1024, 16])
def test_grid_join_equals_brute_force(spark, block):
    rows = vectors(1)
    u = {i: (unit(v), label) for i, v, label in rows if i is not None}
    links, group = dict.fromkeys(u, 0), {i: i for i in u}
    for a in sorted(u):
        for b in sorted(u):
            if b < a and u[a][0] is not None and u[b][0] is not None and u[a][1] == u[b][1] is not None and len(u[a][0]) == len(u[b][0]) and u[a][0] @ u[b][0] >= 0.93:
                links[a] += 1
                links[b] += 1
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    assert sum(links.values()) > 100
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1)).withColumn("size", F.lit("x"))
    got = ego_join.link_vectors(df, block=block).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], group[r.vec_id], group[r.vec_id] == r.vec_id), r
    assert ego_join.link_vectors(df.limit(0)).count() == 0


def test_grid_join_of_ids_with_several_vectors(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 8))
    rows = [(int(i), [float(x) for x in base[k] + rng.normal(size=8) * 0.05], int(label)) for i, k, label in zip(rng.integers(0, 12, 60), rng.integers(0, 6, 60), rng.integers(0, 2, 60), strict=True)]
    rows = sorted([*rows, rows[0], (rows[1][0], [1.0, 0.0], 0)])
    u = [unit(v) for _, v, _ in rows]
    links, group = linked_rows(len(rows), lambda a, b: rows[a][2] == rows[b][2] and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.93)
    least = {g: min(i for (i, _, _), h in zip(rows, group, strict=True) if h == g) for g in group}
    expected = sorted((i, n, least[g]) for (i, _, _), n, g in zip(rows, links, group, strict=True))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for block in (1024, 4):
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in ego_join.link_vectors(df, block=block).collect()) == expected


def nearest(rows, k=5):
    """The k nearest other rows of each query row that takes part, as (query id, [(score, id)], all scores)."""
    u = [unit(v) for _, v in rows]
    for q, x in enumerate(u):
        if rows[q][0] is not None and rows[q][0] % 50 == 0 and x is not None:
            others = [(-float(x @ y), rows[c][0]) for c, y in enumerate(u) if c != q and y is not None and len(y) == len(x) and rows[c][0] is not None]
            yield rows[q][0], x, sorted(others)[:k]


@pytest.mark.parametrize(("sf", "shard"), [("sf0.1", perm_index.SHARD), ("sf0.1", 500), ("sf0.01", 60)])
def test_permutation_index_recall(spark, sf, shard):
    rows = [tuple(r) for r in table(spark, f"/root/testdata/{sf}", "embeddings").select("vec_id", "embedding").collect()]
    rows += [(100_000 + i, v) for i, v, _ in vectors(2) if i and i >= 1000] + [(None, rows[0][1])]
    if shard > 60:  # shards are ranked, not returned whole
        assert perm_index.MORE + perm_index.SHARE * min(shard, len(rows)) < 0.3 * min(shard, len(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("ids", F.lit(1)).withColumn("dim", F.lit("x"))
    got = {}
    for r in perm_index.search(df, F.col("vec_id") % 50 == 0, shard=shard).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    u = {i: unit(v) for i, v in rows}
    for q, x, near in nearest(rows):
        found = sorted(got.pop(q, []))
        assert [f[0] for f in found] == list(range(1, len(near) + 1))
        assert all(abs(s - x @ u[i]) < 1e-12 for _, i, s in found) and [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        hits += sum(s >= -near[-1][0] - 1e-12 for _, _, s in found)
        total += len(near)
    assert not got and total > 0 and hits >= 0.9 * total
    assert perm_index.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_permutation_index_of_repeated_rows(spark):
    rng = np.random.default_rng(5)
    v = [[float(x) for x in rng.normal(size=4)] for _ in range(5)]
    rows = [(0, v[0]), (0, v[0]), (0, v[1]), (50, v[0]), (1, v[0]), (2, v[2]), (2, v[3]), (3, v[4]), (100, [1.0, 2.0])]
    got = sorted((r.query_id, round(r.score, 9), r.vec_id) for r in perm_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect())
    expected = {(q, tuple(x), round(-s, 9), i, n) for q, x, near in nearest(rows) for n, (s, i) in enumerate(near)}  # rows that repeat both ask once
    assert got == sorted((q, s, i) for q, _, s, i, _ in expected)


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix_sources", "tokenize"]
    kept = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    texts = brute_lines(kept)
    kept = [(i, new, s) for (i, _, s), new in zip(kept, texts, strict=True)]
    _, group = brute_groups([(i, t) for i, t, _ in kept])
    kept = {i: (t, s) for i, t, s in kept if group[i] == i}
    t = tokenizer()
    rows = corpus_pipeline.run(spark, SF).collect()
    counts, size, words = {}, {}, lambda x: len(re.findall(mixing.WORD, x))
    for s in {s for _, s in kept.values()}:
        size[s] = sum(words(x) for x, y in kept.values() if y == s)
    for r in rows:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert np.frombuffer(r.ids, "<u4").tolist() == t.encode(kept[r.doc_id][0], add_special_tokens=False).ids and r.decoded_ok
    assert set(counts) <= set(kept) and max(counts.values()) <= 2
    for s, target in brute_targets(size).items():
        taken = sum(n * words(kept[i][0]) for i, n in counts.items() if kept[i][1] == s)
        assert abs(taken - target) <= max(words(x) for x, y in kept.values() if y == s)


def test_pipeline_of_awkward_rows(spark, awkward, nothing, tmp_path):
    awkward = awkward.withColumns({c: F.lit("x") for c in ("n_lines", "n_dropped", "th", "copies", "n_tokens", "lang_pred", "h")})
    for name, docs in (("awkward", awkward), ("nothing", nothing), ("bare", awkward.select("doc_id", "text", "lang", "source"))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        columns = docs.columns
        for stage, run in corpus_pipeline.STAGES[:-1]:
            out = run(spark, docs, f"{tmp_path}/{name}")
            assert out.columns == columns and out.dtypes == docs.dtypes, stage
            docs = out
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r.decoded_ok for r in rows) and (not rows) == (name == "nothing")
        assert {r.doc_id for r in rows} <= {None, 4, 6, 7, 8, 9, 11} if name != "nothing" else True


def test_keys_with_many_rows_meet_their_class(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") % 10 * (F.col("id") % 3)).alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS LONG) k, 9000L id"))
    classes = rows.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 4")
    expected = sorted(map(str, rows.join(classes, "k", "left").collect()))
    assert max(r.n for r in classes.collect()) > 256 > min(r.n for r in classes.collect())
    got = by_class(rows, classes, ["k"], "n")
    assert sorted(map(str, got.select("k", "id", "n").collect())) == expected
    inner = by_class(rows, classes, ["k"], "n", "inner").select("k", "id", "n")
    assert sorted(map(str, inner.collect())) == sorted(map(str, rows.join(classes, "k").collect()))


def test_lowest_by_hash_is_a_sample_of_each_group(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 7 == 0, F.lit(None)).otherwise("often").alias("g"))
    ranked = lambda df: sorted((r.id for r in df.collect()))
    everyone = rows.where("g = 'often'").orderBy(F.xxhash64(F.lit(3), "id")).limit(300)
    got = lowest_by_hash(rows.where("g IS NOT NULL"), "g", "id", 300, 3)
    assert got.where("g = 'rare'").count() == 200 and ranked(got.where("g = 'often'")) == ranked(everyone)
