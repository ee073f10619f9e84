"""Encoding, licenses, languages, quality, lines and mixing on awkward rows and against other implementations."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import same_as_sql
from weft.llm import bpe, langid, license, line_dedup, mixing, quality, queries
from weft.llm.common import table

SF = "/root/testdata/sf0.001"


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, r)
    return out


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_bpe_equals_the_library(spark, awkward, nothing):
    t = tokenizer()
    rows = by_id(bpe.encode(awkward, queries.tokenizer_path(), decoded=True).collect())
    assert bpe.encode(awkward, queries.tokenizer_path()).count() == 13
    for doc_id, text, *_ in map(tuple, awkward.select("doc_id", "text").collect()):
        ids = t.encode(text or "", add_special_tokens=False).ids
        got = rows[doc_id]
        assert np.frombuffer(got.ids, "<u4").tolist() == ids and got.n_tokens == len(ids)
        assert got.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe.encode(nothing, queries.tokenizer_path()).count() == 0
    back = bpe.decode(bpe.encode(awkward, queries.tokenizer_path()), queries.tokenizer_path())
    assert {r.doc_id: r.text for r in back.collect()}[7] == "Straße été \U0001f642 " * 60


def test_bpe_on_random_texts():
    v, t = bpe.vocabulary(open(queries.tokenizer_path(), "rb").read()), tokenizer()
    rng = random.Random(2)
    pool = [*"abcdefgh the in  \n\t.,'s129éüß中文 　", "<|endoftext|>", "  ", "aaaaaa", "ing", "'ll", "\r\n", "²", "====", "́"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        ids = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(v.encode(text), "<u4").tolist() == ids
        assert v.decode(np.array(ids, np.int64)) == t.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark):
    t = tokenizer()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in queries.op4_bpe(spark, SF).collect():
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name", ["op5_license", "op8_line_dedup"])
def test_same_as_sql(spark, name):
    same_as_sql(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_license_scan(spark, awkward, nothing):
    got = by_id(license.scan(awkward).collect())
    assert license.scan(awkward).count() == 13 and license.scan(nothing).count() == 0
    r = got[8]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (7, 1, 0, 0, "mit", "all-rights-reserved,mit", 1.0)
    assert (got[1].n_words, got[1].first_word, got[1].labels, got[1].score) == (0, None, "", 0.0)
    rows = [(1, "cc by nc cc-by-nc. CC BY\nNC xapache license version 2 and Apache License, Version 2"), (2, "under the MIT license"), (3, "gnu general public license version 3 is under this work, licensed the")]
    rows += [
        (4, 'x\n# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the "Software"), to deal\n# in the Software without restriction, including without limitation the rights\n# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n# copies of the Software'),
        (5, "some words here. Redistribution and use in source and binary\nforms, with or without\n\nmodification, are permitted" + " and so on" * 50),
        (6, "GNU Affero\nGeneral Public License\nVersion 3"), (7, "all of it is well and good\nrights are " + "not " * 30 + "reserved"),
        (7, "All rights\nreserved."), (8, None), (9, "rights reserved all rights all reserved " * 3000), (None, "all rights reserved"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("token", "label", "block", "x", "words")})
    all_rows = license.scan(df).collect()
    assert sorted(r.labels for r in all_rows if r.doc_id == 7) == ["", "all-rights-reserved"] and len(all_rows) == len(rows)
    got = by_id(all_rows)
    assert [got[k].labels for k in (4, 5, 6, 8, 9, None)] == ["mit", "bsd", "agpl-3", "", "all-rights-reserved", "all-rights-reserved"]
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (4, 0, 14, "apache-2,cc-by-nc")
    assert got[2].n_base == 0 and got[3].labels == "gpl-3" and got[3].score == 1.0


def brute_lines(docs):
    pages, hosts = {}, {}
    for _, text, host in docs:
        hosts[host] = hosts.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""} if text is not None else ():
            pages[host, line] = pages.get((host, line), 0) + 1
    gone = {k for k, n in pages.items() if n >= line_dedup.MIN_PAGES and n > hosts[k[0]] * line_dedup.RATIO}
    return [None if text is None else "\n".join(x for x in text.split("\n") if (host, x.strip(" ")) not in gone) for _, text, host in docs]


def test_line_dedup_of_small_hosts_and_clashing_names(spark):
    rows = [(1, "a\nfoot", "three"), (2, "b\nfoot", "three"), (3, "c\nfoot", "three"), (4, "only\nfoot", "one"), (5, "x\ny", "two"), (6, "x\nz", "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("kept") for c in ("n_lines", "n_dropped", "host", "line", "pages", "h1")})
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert [got[k].text for k in range(1, 7)] == brute_lines(rows) == ["a", "b", "c", "only\nfoot", "y", "z"]
    assert [(got[k].n_lines, got[k].n_dropped) for k in (1, 4)] == [(2, 1), (2, 0)] and got[1].pages == "kept"
    out = line_dedup.without_boilerplate(df)
    assert out.columns == df.columns and {(r.n_lines, r.n_dropped) for r in out.collect()} == {("kept", "kept")}
    assert {r.doc_id: r.text for r in out.collect()} == {k: r.text for k, r in got.items()}


@pytest.mark.parametrize("limit", [200_000, -1])
def test_line_dedup_in_both_joins(spark, awkward, nothing, limit, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
    rows = [(i, f"menu\nown {i}\n menu \n\nfoot {i % 3}", ["h", None][i % 2]) for i in range(40)] + [(90, None, "h"), (91, "menu", None)]
    # a page that has a line with and without white space around it counts once
    rows += [(100 + i, "few\n few\nfew " if i < 3 else f"page {i}", "indented") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert [got[r[0]] for r in rows] == brute_lines(rows) and got[91] == ""
    out = line_dedup.dedup_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines", "n_dropped"] and out.count() == 13
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_language_id(spark, awkward, nothing):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id < 500")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == 500 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - 1) < 1e-6 for r in rows)
    got = langid.identify(awkward).collect()
    assert len(got) == 13 and {r.doc_id: r.lang_pred for r in got}[1] == "und" == {r.doc_id: r.lang_pred for r in got}[3]
    assert langid.identify(nothing).count() == 0
    nolang = spark.createDataFrame([(1, "text")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert langid.identify(nolang).first().lang_pred == "und"


def test_mixture_of_two_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.learn(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) BETWEEN 1000 AND 3000").collect()}
    which, share = langid.infer(model, langid.trigrams(texts["en"][:900] + " " + texts["de"][:900]))
    assert {model.langs[k] for k in which} == {"en", "de"} and 0.3 < share[0] < 0.7
    which, share = langid.infer(model, langid.trigrams(texts["fr"]))
    assert [model.langs[k] for k in which] == ["fr"] and share[0] == 1


def brute_trigrams(text):
    """Counts of hashed trigrams: letters in lower case, whatever stands between them one gap, a gap at both ends."""
    word = (1 << 32) - 1

    def code(a, b, c):
        h = ((a * 0x9E3779B1 + b) * 0x85EBCA6B + c) & word
        h = ((h ^ h >> 15) * 0xC2B2AE35) & word
        return (h ^ h >> 16) >> 32 - langid.BITS

    letters = re.sub(r"\0+", "\0", "".join(c.lower()[0] if c.isalpha() else "\0" for c in text))
    padded = "\0" + letters + "\0" if letters.strip("\0") else ""
    out = {}
    for k in range(len(padded) - 2):
        h = code(*map(ord, padded[k : k + 3]))
        out[h] = out.get(h, 0) + 1
    return out


def brute_languages(samples, text):
    """(language, proportions) by plain dictionaries and loops."""
    counts = {}
    for lang, sample in samples:
        for g, n in brute_trigrams(sample).items():
            counts.setdefault(lang, {}).setdefault(g, 0)
            counts[lang][g] += n
    names, room = sorted(counts), langid.SMOOTHING * 2**langid.BITS
    total = {k: sum(counts[k].values()) + room for k in names}
    p = lambda k, g: (counts[k].get(g, 0) + langid.SMOOTHING) / total[k]
    grams = brute_trigrams(text)
    if not grams or not names:
        return "und", {}

    def mixture(langs):
        share = dict.fromkeys(langs, 1 / len(langs))
        for _ in range(langid.STEPS):
            new = dict.fromkeys(langs, 0.0)
            for g, n in grams.items():
                whole = sum(p(k, g) * share[k] for k in langs)
                for k in langs:
                    new[k] += n * p(k, g) * share[k] / whole
            share = {k: v / sum(grams.values()) for k, v in new.items()}
        return share, sum(n * math.log(sum(p(k, g) * share[k] for k in langs)) for g, n in grams.items())

    alone = {k: sum(n * math.log(p(k, g)) for g, n in grams.items()) for k in names}
    chosen = [max(names, key=lambda k: alone[k])]
    share, best = {chosen[0]: 1.0}, alone[chosen[0]]
    everyone, _ = mixture(names)
    for k in sorted(names, key=lambda k: -everyone[k]):
        if k not in chosen:
            more, fit = mixture([*chosen, k])
            if fit - best <= langid.PENALTY * math.log(sum(grams.values()) + 1):
                break
            chosen, share, best = [*chosen, k], more, fit
    return max(chosen, key=lambda k: share[k]), share


def test_language_id_equals_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id < 260 AND length(text) < 2500")
    all_rows = docs.select("doc_id", "text", "lang").collect()
    mixed = [(10_000 + k, a.text[:400] + "\n" + b.text[:300], None) for k, (a, b) in enumerate(zip(all_rows[:30], all_rows[30:60], strict=True))]
    mixed += [(20_000, "1 2 3", None), (20_001, "x", None), (20_002, "", None), (20_003, "ÉTÉ été", None)]
    rows = spark.createDataFrame([*map(tuple, all_rows), *mixed], "doc_id long, text string, lang string")
    samples = [(r.lang, r.text) for r in rows.collect() if r.lang and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = langid.identify(rows).collect()
    several = 0
    for r in got[::4] + got[-40:]:
        lang, share = brute_languages(samples, texts[r.doc_id])
        assert (r.lang_pred, set(r.langs)) == (lang, set(share)), r.doc_id
        assert all(abs(x - share[k]) < 1e-9 for k, x in zip(r.langs, r.shares, strict=True))
        several += len(share) > 1
    assert several >= 5


def test_no_language_is_too_rare_to_learn(spark):
    rng = np.random.default_rng(2)
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]
    rows = []
    for k in range(430):
        own = rng.choice(alphabet, 8)
        rows += [(k * 10 + i, "".join(rng.choice(own, 60)), f"l{k:03d}") for i in range(3 if k else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert len(model.langs) == 430
    got = langid.predict(df, model).collect()
    assert sum(r.lang_pred == lang for r, (_, _, lang) in zip(sorted(got, key=lambda r: r.doc_id), rows, strict=True)) >= 0.99 * len(rows)


def test_kept_is_what_has_a_language(spark, awkward, nothing):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id < 500")
    texts = {r.lang: r.text for r in docs.where("length(text) BETWEEN 1000 AND 3000").collect()}
    assert len(texts) == 4
    names = sorted(texts)
    mixed = [(20_000 + n, "\n".join(texts[k][:900] for k in names[:n]), None, "m", 0) for n in (3, 4)] + [(20_005, "1 2 3", None, "m", 0)]
    rows = docs.unionByName(spark.createDataFrame(mixed, "doc_id long, text string, lang string, source string, n_chars long"))
    predicted = langid.identify(rows).collect()
    assert {r.doc_id: r.score < 0.5 for r in predicted}[20_003] and {r.doc_id: r.score < 0.5 for r in predicted}[20_004]
    kept = langid.keep_identified(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in predicted if r.lang_pred != "und")
    assert {r.doc_id for r in langid.keep_identified(awkward).collect()}.isdisjoint({1, 2, 3}) and langid.keep_identified(awkward).count() == 10
    assert langid.keep_identified(nothing).count() == 0


def test_quality(spark, awkward, nothing):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents").where("doc_id < 3000"), table(spark, "/root/testdata/sf0.1", "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.classify(docs, labels).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id in truth]
    assert len(rows) == 3000 and all(r.held_out for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    got = quality.classify(awkward, spark.createDataFrame([(2, 0, 0), (4, 1, 0), (4, 0, 0), (9, 1, 0), (None, 1, None), (8, None, 0)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    none = quality.classify(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and quality.classify(nothing, labels).count() == 0


def brute_score(m, text):
    """Score, lines and good lines of a text by the model: features counted character by character, all labelings tried."""
    raw = [line.encode() for line in text.split("\n")]
    kinds, rows = quality.KIND, []
    for line in raw:
        n = max(1, len(line))
        count = lambda k: sum(kinds[c] == k for c in line)  # noqa: B023, E731
        words = [w for w in re.split(rb"[\t\x0b\x0c\r ]+", line) if w]
        bags = [sorted(w) for w in words]
        stops = sum(len(w) > 0 and kinds[w[-1]] >= quality._STOP for w in words)
        nw = max(1, len(words))
        rows.append([
            math.log1p(len(line)), len(words), (count(quality._LOWER) + count(quality._HIGH)) / n, *[count(k) / n for k in (quality._UPPER, quality._DIGIT, quality._STOP, quality._BANG, quality._PIPE, quality._OTHER)],
            sum(a == b for a, b in zip(bags, bags[1:], strict=False)) / nw, sum(a == b for a, b in zip(bags, bags[2:], strict=False)) / nw, len(line) / nw, stops / nw,
        ])
    bins = [[sum(np.float32(x) >= e for e in m.edges[f]) for f, x in enumerate(r)] for r in rows]
    none = [quality.BINS] * quality.FEATURES
    u = [
        m.bias + sum(m.weights[k, f][b[f]] for k, b in enumerate((bins[i], bins[i - 1] if i else none, bins[i + 1] if i + 1 < len(bins) else none)) for f in range(quality.FEATURES))
        for i in range(len(bins))
    ]
    total, good = 0.0, np.zeros(len(u))
    for code in range(1 << len(u)):
        y = [code >> k & 1 for k in range(len(u))]
        w = math.exp(sum(a * b for a, b in zip(u, y, strict=True)) + sum(m.coupling[a, b] for a, b in zip(y, y[1:], strict=False)))
        total, good = total + w, good + w * np.array(y)
    good /= total
    weight = np.array([len(x) + 1.0 for x in raw])
    mean = min(max(float(good @ weight / weight.sum()), 1e-4), 1 - 1e-4)
    return 1 / (1 + math.exp(-(m.scale * math.log(mean / (1 - mean)) + m.shift))), len(raw), int((good >= 0.5).sum())


def test_quality_equals_brute_force(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents").where("doc_id < 2000"), table(spark, "/root/testdata/sf0.1", "labels")
    model = quality.learn(docs, labels)
    short = {r.doc_id: "\n".join(r.text.split("\n")[:9]) for r in docs.limit(300).collect()}
    short |= {-1: "", -2: "\n\n", -3: "word word word\nein Wörtchen! |\t42", -4: " " * 7, -5: "!!!"}
    got = dict(zip(short, zip(*quality.score_texts(model, [t.encode() for t in short.values()]), strict=True), strict=True))
    for k, text in short.items():
        score, lines, good = brute_score(model, text)
        assert abs(got[k][0] - score) < 1e-9 and tuple(got[k][1:]) == (lines, good), (k, text)
    whole = spark.createDataFrame(list(short.items()), "doc_id long, text string")
    # the query scores with a model of its own: learned from no row here, it can't tell
    assert {r.score for r in quality.classify(whole, labels.limit(0)).collect()} == {0.5}


def test_quality_learns_from_a_bounded_number_of_lines(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_LINES", 50)
    rows = [(i, "\n".join([["Good prose stands here.", "x | y | !!"][i % 2]] * (60 if i == 3 else 5))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda f, length, per_text, label: seen.append((per_text, label)))
    quality.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    (per_text, label), = seen
    assert [int(per_text[label == y].sum()) for y in (0, 1)] == [50, 50]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    u, c, per = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([4, 1, 2])
    forward, backward = quality._messages(u, per, c)
    got, at = quality._sigmoid(forward + backward), 0
    for n in per:
        total = np.zeros((n, 2))
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(u[at + k] * y[k] for k in range(n)) + sum(c[y[k], y[k + 1]] for k in range(n - 1)))
            for k in range(n):
                total[k, y[k]] += w
        assert np.allclose(got[at : at + n], total[:, 1] / total.sum(1))
        at += n


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


@pytest.mark.parametrize("leaf", [4096, 8])
def test_mixing(spark, awkward, nothing, leaf):
    docs = table(spark, "/root/testdata/sf0.01", "documents").withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    rows = mixing.mix(docs, leaf_rows=leaf, fan_in=4).collect()
    texts = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    sizes, taken, most = {}, {}, {}
    for r in rows:
        s = texts[r.doc_id][0]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id][1])) and 0 <= r.taken <= 2 * r.size
        sizes[s], taken[s], most[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken, max(most.get(s, 0), r.size)
    targets = brute_targets(sizes)
    for r in rows:
        s = texts[r.doc_id][0]
        assert r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6 * max(1, targets[s])
    assert all(abs(taken[s] - targets[s]) <= most[s] for s in sizes)
    again = mixing.mix(docs.repartition(7), leaf_rows=leaf, fan_in=4).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}
    out = mixing.mix(awkward, leaf_rows=leaf).collect()
    assert len(out) == 13 and all(0 <= r.taken <= 2 * r.size for r in out)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    mixed = mixing.mixed_documents(docs, leaf_rows=leaf)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.mix(docs, leaf_rows=leaf).collect())
