"""Training-data operators against brute force and on edge cases."""

import hashlib
import math
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, langid, licences, mixing, neardup, pii, sharding, suffixdedup, tokenfiles, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kind string, rank int, place int"


def frame(spark, texts, **more):
    rows = [(i, t, more.get("lang", {}).get(i, "en"), f"s{(i or 0) % 3}" if (i or 0) % 7 else None, 0, 1, "x", 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(seed, n, letters="etaoinshrdlu"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, short and very long texts, repeated rows and clashing column names."""
    long = words(1, 6000)
    texts = [(0, None), (1, ""), (2, " \n\t"), (3, "Ab"), (4, long), (5, long), (5, long), (6, "12 ** ++"), (7, words(2, 60)),
             (8, words(2, 60) + " end"), (9, "éàü " * 50), (10, words(3, 40)), (11, words(3, 40))]
    return frame(spark, texts).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_repeats(texts, length=100):
    seen, out = set(), {}
    for at, (i, text) in enumerate(texts):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            piece = data[s:s + length]
            if piece in seen:
                gone[s:s + length] = True
            seen.add(piece)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[at] = (i, len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    if hot:  # every anchor counts as hot, so windows are dealt out one by one
        monkeypatch.setattr(suffixdedup, "LOCAL_HOT", 0)
        monkeypatch.setattr(suffixdedup, "HOT_RUNS", 0)
    base = words(5, 80)
    texts = [(0, None), (1, ""), (2, base), (3, words(6, 10) + base[50:300] + words(7, 10)), (4, base), (4, base), (5, base[:99]), (6, "a" * 400),
             (7, words(8, 5) + base[200:420]), (8, "a" * 150 + "é" * 120), (9, words(9, 30) + base[10:200] + words(9, 30))]
    got = suffixdedup.remove_repeats(frame(spark, texts)).withColumn("kept", F.sha2("kept", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_repeats(texts)


def test_suffix_order_is_the_order_of_the_suffixes():
    data = np.frombuffer(b"banana$bandana$ananas$nanana", np.uint8)
    start = np.arange(len(data))
    order, _ = suffixdedup.suffix_order(suffixdedup.PrefixHashes(data), data, start, len(data) - start, np.zeros(len(data), int))
    assert order.tolist() == sorted(start.tolist(), key=lambda i: data[i:].tobytes())


def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(0)
    v = np.round(r.normal(size=(400, 8)), 1)
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(400, None, 1), (401, [float("nan")] * 8, 1), (402, [None] * 8, 1), (403, [1.0], 1), (3, v[3].tolist(), 1)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), F.col("vec_id") % 20 == 0, 5, scale=64).collect()
    z = np.floor(64 * v)
    want = []
    for q in range(0, 400, 20):
        s = z @ z[q]
        best = [j for j in np.lexsort((np.arange(400), -s)) if j != q][:5]
        want += [(q, k + 1, j, int(s[j])) for k, j in enumerate(best)]
    assert sorted(tuple(x) for x in got) == sorted(want)


def test_tile_bounds_stop_early_and_stay_exact():
    r = np.random.default_rng(1)
    rows = np.floor(r.normal(size=(3000, 4)) * 20)
    found = {int(q): (ids.tolist(), s.tolist()) for q, ids, s in topk.tile_top_k(rows[:9], np.arange(9), rows, np.arange(3000), 20)}
    for q in range(9):
        s = rows @ rows[q]
        best = [j for j in np.lexsort((np.arange(3000), -s)) if j != q][:20]
        assert found[q] == (best, s[best].astype(int).tolist())
    big = np.array([[2.0**60, 1.0], [2.0**60, 2.0]])
    assert [x[2].tolist() for x in topk.tile_top_k(big, np.arange(2), big, np.arange(2), 1)] == [[2**63 - 1]] * 2


def test_near_duplicates(spark, odd):
    got = {}
    for r in neardup.near_duplicates(odd).collect():
        got.setdefault(r["doc_id"], []).append(r["class_id"])
    assert got == {0: [0], 1: [1], 2: [2], 3: [3], 4: [4], 5: [4, 4], 6: [6], 7: [7], 8: [7], 9: [9], 10: [10], 11: [10]}


def test_large_group_of_near_copies(spark):
    base = words(11, 120).split()
    texts = [(i, " ".join(w for j, w in enumerate(base) if j != i % 120) + f" tail{i}") for i in range(300)] + [(i, words(i, 60)) for i in range(300, 330)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert {got[i] for i in range(300)} == {0} and all(got[i] == i for i in range(300, 330))


def brute_classes(texts):
    runs, root = {i: neardup.kmers(t) for i, t in texts}, {i: i for i, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in runs:
        for j in runs:
            if i < j and neardup.similarity(runs[i], runs[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in runs}


def edited(seed, text, n=6):
    """The text with ``n`` of its words replaced."""
    r, ws = random.Random(seed), text.split()
    for k in r.sample(range(len(ws)), n):
        ws[k] = f"edit{seed}x{k}"
    return " ".join(ws)


def test_star_and_bridge_of_near_copies_against_brute_force(spark):
    base = words(21, 304)
    star = [(1000 + i, edited(i, base)) for i in range(300)] + [(5000, base)]
    # two clusters that only a text between them links
    left, ws = words(22, 304), words(22, 304).split()
    far = " ".join("far" + w if j % 40 == 7 else w for j, w in enumerate(ws))
    half = " ".join("far" + w if j % 40 == 7 and j < 150 else w for j, w in enumerate(ws))
    bridge = [(6000 + i, left + f" l{i}") for i in range(40)] + [(7000 + i, far + f" r{i}") for i in range(40)] + [(8000, half)]
    texts = star + bridge
    want = brute_classes(texts)
    assert len({want[i] for i, _ in star}) == 1 and not neardup.similarity(neardup.kmers(star[0][1]), neardup.kmers(star[1][1]))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert got == want


def test_families_of_a_common_text_are_hardly_aligned_with_each_other(spark, monkeypatch):
    base, asked, real = words(23, 200), [], neardup.verified
    # no text has runs for itself but those of its last word; texts of two families share much, and are not similar
    texts = [(i, edited(100 + i % 60, base, 5) + f" end{i}") for i in range(240)]
    monkeypatch.setattr(neardup, "verified", lambda pairs, *more: asked.append(pairs.count()) or real(pairs, *more))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute_classes(texts) == {i: i % 60 for i in range(240)}
    assert sum(asked[2:]) <= 240  # after the first two rounds


def test_parities_never_hide_a_link():
    r = random.Random(5)
    for n in (3, 40, 300, 3000):
        for seed in range(40):
            text = words(seed, n)
            a, b = neardup.kmers(text), neardup.kmers(edited(seed, text, r.randint(0, n // 10)))
            apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(*(neardup.parities(v).view(np.uint64) for v in (a, b))))
            assert apart <= len(np.setxor1d(a, b))


def test_similarity_is_that_of_ordered_runs():
    a, b = neardup.kmers(words(1, 100)), neardup.kmers(words(1, 100) + " more")
    assert neardup.similarity(a, a) == 1.0 and neardup.similarity(a, b) == len(a) / (len(a) + 1)
    assert neardup.similarity(a, a[::-1]) == 0.0 and neardup.similarity(a, a[:0]) == 0.0


def test_languages(spark, odd):
    texts, lang = [], {}
    for i in range(120):
        lang[i] = "xx" if i % 2 else "yy"
        texts.append((i, words(i, 60, "abcdef" if i % 2 else "uvwxyz")))
    texts += [(200, None), (201, "123 !"), (202, "q" * 300), (203, words(1, 30, "ABCDEF"))]
    lang |= {200: "xx", 201: None, 202: None, 203: None}
    got = {r["doc_id"]: r for r in langid.identify(frame(spark, texts, lang=lang), learn=F.col("doc_id") % 3 != 0).collect()}
    assert all(got[i]["lang_pred"] == lang[i] and not got[i]["rejected"] for i in range(120))
    assert [(got[i]["lang_pred"], got[i]["rejected"]) for i in (200, 201)] == [("und", True)] * 2
    assert got[202]["rejected"] and got[203]["lang_pred"] == "xx"
    assert langid.identify(odd).count() == odd.count()


def test_only_letters_make_a_language(spark):
    emoji, deseret = "\U0001f600\U0001f680 " * 30, "\U00010400\U00010428" * 20
    assert not len(langid.grams(emoji)) and len(langid.grams(deseret)) and not len(langid.grams("\ud800 1"))
    assert langid.grams("ab\U0001f600c").tolist() == langid.grams("ab!c").tolist()
    docs = frame(spark, [(i, words(i, 40)) for i in range(40)] + [(100, emoji), (101, None), (102, "7 \u00b1 !")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()}
    assert {got[i] for i in (100, 101, 102)} == {("und", 0.0)} and got[3][0] == "en"


def test_licences_of_null_keys(spark):
    docs = frame(spark, [(i, words(i, 30) + "\n" + ("Released under the MIT License." if i % 2 else words(i + 500, 8))) for i in range(200)])
    model = licences.train(docs, "doc_id", "text")
    odd = frame(spark, [(None, "Released under the MIT License."), (None, None), (1, words(3, 9))])
    assert sorted(((r["doc_id"], r["licence"]) for r in licences.scan(odd, model).collect()), key=str) == [(1, "none"), (None, "mit"), (None, "mit")]


def test_kneser_ney_probabilities_sum_to_one():
    g, n = np.unique(langid.grams("abc abd abe bcd abc"), return_counts=True)
    model = langid.KneserNey(g, n)
    context = langid.grams("xab")[-2] & ~np.uint64(0xFFFF)
    total = model.probability(context | np.arange(65536, dtype=np.uint64)).sum()
    assert math.isclose(total, 1.0, rel_tol=1e-6)


def test_every_four_gram_and_language_counts(spark, monkeypatch):
    """More than a hundred languages, and pieces of a few four-grams, give what one whole model per language gives."""
    lang = {i: f"l{i % 103:03}" for i in range(206)}
    texts = [(i, words(i % 103, 12, "abcdefghijklmnop"[i % 13:i % 13 + 4])) for i in range(206)]
    docs = frame(spark, texts, lang=lang)
    whole = {}
    for name in sorted(set(lang.values())):
        g, n = np.unique(np.concatenate([langid.grams(t) for i, t in texts if lang[i] == name]), return_counts=True)
        whole[name] = langid.KneserNey(g, n)
    want = {}
    for i, t in texts:
        bits = {name: float(-np.log2(m.probability(langid.grams(t))).mean()) for name, m in whole.items()}
        want[i] = min(bits.values())
        assert bits[lang[i]] < 1.001 * want[i]
    for most in (10**6, 2_000):
        monkeypatch.setattr(langid, "MAX_ENTRIES", most)
        trained = langid.train(docs)
        assert len(trained.languages) == 103 and (len(trained.ranges) > 3) == (most == 2_000)
        got = {r["doc_id"]: r for r in langid.scored(docs, trained, "text", ["doc_id"]).collect()}
        assert len(got) == 206 and all(math.isclose(got[i]["bits"], want[i], rel_tol=1e-4) for i in want)


def test_personal_data(spark, odd):
    text = "Call +1 (555) 010-9999, mail a.b@c.de@f.gh or 10.0.0.1 and 300.1.1.1; pay 4539 1488 0343 6467 now, not 4539148803436468."
    docs = frame(spark, [(1, text), (2, None), (3, "")] + [(i, words(i, 20) + f" x{i}@mail.example.com " + words(i, 9)) for i in range(10, 40)])
    got = {r["doc_id"]: r["spans"] for r in pii.find_spans(docs, pii.train(docs, "doc_id", "text")).collect()}
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}
    base = [(s["kind"], text[s["start"]:s["end"]]) for s in got[1] if s["base"]]
    assert base == [("email", re.search(plain["email"], text).group()), ("ip", "10.0.0.1"), ("card", "4539 1488 0343 6467"), ("phone", "+1 (555) 010-9999")]
    assert got[2] == got[3] == [] and all(len([s for s in got[i] if s["base"]]) == 1 for i in range(10, 40))
    assert pii.find_spans(odd, pii.SpanModel()).count() == odd.count()


def test_mix_meets_targets(spark, odd):
    texts = [(i, words(i, 5 + i % 40)) for i in range(600)] + [(600, None), (601, "")]
    docs = frame(spark, texts)
    rows = mixing.mix(docs).collect()
    sizes, taken = {}, {}
    for r in rows:
        assert r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    target = {r["source"]: r["target"] for r in rows}
    assert all(abs(taken[s] - target[s]) <= 30 and target[s] <= 3 * sizes[s] + 1e-6 for s in target)
    assert math.isclose(sum(target.values()), sum(sizes.values())) and len(target) == 4
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, rows))
    assert mixing.mix(odd).count() == odd.count()


def test_shards(spark, odd):
    texts = [(i, words(i % 300, 5 + i % 50)) for i in range(900)]
    rows = sharding.shard(frame(spark, texts)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
        text = dict(texts)[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text.encode()))
    total = [sum(r["size"] for r in x) for x in by.values()]
    assert sorted(by) == list(range(8)) and max(total) < 1.2 * min(total)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    shards = {}
    for r in rows:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(x) == 1 for x in shards.values())
    assert sharding.shard(odd).count() == odd.count()


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, words(50, 30)), (2, "one two three"), (3, None), (4, ""), (5, words(51, 20))], "item_id long, text string")
    docs = frame(spark, [(1, words(1, 500) + ". " + words(50, 30).upper() + "! " + words(2, 500)), (2, "One, two; three"), (3, words(3, 90)),
                         (4, None), (5, " ".join(words(50, 30).split()[:20])), (6, words(51, 20)), (6, "twice")])
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 2), (6, 5)}
    assert decontamination.contaminated(odd, items).count() == 0 and decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_token_files_round_trip(spark, odd, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = frame(spark, [(3, "The cat's hat, 12 <|endoftext|> é x\x1cy"), (1, None), (2, ""), (9, words(1, 5000)), (9, words(1, 5000)),
                        (4, "ABC Mixed CASE'S don't x2y \u212a \u00c9t\u00e9 a"), *[(20 + i, words(i, 30, string.ascii_letters)) for i in range(40)]])
    monkeypatch.setattr(tokenfiles, "PART_BYTES", 5000)
    folder = tokenfiles.token_folder(docs)
    got = sorted(tuple(r) for r in tokenfiles.read_token_files(tokenfiles.write_token_files(docs, path, folder), folder).collect())
    plain, start, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(((r["doc_id"], r["text"] or "") for r in docs.collect())):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_token_ids_take_the_narrowest_type(spark):
    import public_tokenizers

    words_ = tokenfiles.WordCachedTokenizer(public_tokenizers.path("word_bpe_49k.json"), 1)
    assert words_.dtype == np.uint16 and words_.plain("ABc") == "abc"
    assert tokenfiles.WordCachedTokenizer(public_tokenizers.path("word_bpe_49k.json"), 1 << 17).dtype == np.uint32
    text = "Plain WORDS and, others-like 42 these: \u00fcber .. it's Done!? e.g. (so). A,b x!; can't. \ufb01n. \u00c9T\u00c9*** \u00e9a\u0301 stra\u00dfe\u00bf ab_\""
    assert np.frombuffer(words_.ids([text])[0], np.uint16).tolist() == words_._encode(text).ids


def test_null_keys_make_the_first_part(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = frame(spark, [(None, "b a"), (-5, "c"), (None, "a"), (7, "d e f")])
    folder = tokenfiles.token_folder(docs)
    got = sorted(tokenfiles.read_token_files(tokenfiles.write_token_files(docs, path, folder), folder).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [(None, 0, got[0]["n_tokens"]), (None, got[0]["n_tokens"], got[1]["n_tokens"]), (-5, 5, 2), (7, 7, 4)]


def test_licences(spark, odd):
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved."]
    docs = frame(spark, [(i, words(i, 30) + "\n" + (lines[i % 3] if i % 2 else words(i + 500, 8))) for i in range(200)] + [(900, None), (901, "")])
    model = licences.train(docs, "doc_id", "text")
    got = {r["doc_id"]: r["licence"] for r in licences.scan(docs, model).collect()}
    assert all(got[i] == (["apache", "mit", "reserved"][i % 3] if i % 2 else "none") for i in range(200))
    assert got[900] == got[901] == "none" and licences.scan(odd, model).count() == odd.count()


def test_wrapped_licences(spark):
    """Notices wrapped at 40 to 80 characters, in the midst of other lines and behind comment marks, count once."""
    import textwrap

    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved."]
    docs = frame(spark, [(i, words(i, 30) + "\n" + (lines[i % 3] if i % 2 else words(i + 500, 8))) for i in range(200)])
    model = licences.train(docs, "doc_id", "text")
    known = [(f, t) for f, t in licences.NOTICES if len(t) > 80 and f != "cc-by"]  # cc-by stays unknown on one line too
    texts, want = [], {}
    for width in (40, 50, 60, 72, 80):
        for family, notice in known:
            for mark in ("", "# "):
                i = len(texts)
                texts.append((i, words(i, 12) + "\n" + "\n".join(mark + x for x in textwrap.wrap(notice, width)) + "\n" + words(i + 900, 12)))
                want[i] = (family, family, 1, 0)
    header = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License"
    texts.append((900, header))
    want[900] = ("gpl", "gpl", 1, 0)
    texts.append((901, header.replace("\n", "\n\n")))  # a border between: no whole notice
    texts.append((902, "\n".join([words(1, 9), lines[1], lines[1], words(2, 9)])))
    want[902] = ("mit", "mit", 2, 0)
    got = {r["doc_id"]: (r["licence"], r["families"], r["n_paragraphs"], r["n_unknown"]) for r in licences.scan(frame(spark, texts), model).collect()}
    assert got[901][0] in ("unknown", "none")
    assert {i: got[i] for i in want} == want


def test_empty_tables(spark, none):
    assert suffixdedup.remove_repeats(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert langid.identify(none).count() == 0
    assert pii.find_spans(none, pii.train(none, "doc_id", "text")).count() == 0
    assert mixing.mix(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True), 3, scale=64).count() == 0
    folder = tokenfiles.token_folder(none)
    import public_tokenizers

    assert tokenfiles.read_token_files(tokenfiles.write_token_files(none, public_tokenizers.path("word_bpe_49k.json"), folder), folder).count() == 0


def test_licence_scan_keeps_only_lines_that_speak_for_a_family(spark, monkeypatch):
    notices = [t for _, t in licences.NOTICES]
    plain = [(i, words(i, 30) + "\n" + words(i, 20) + " this work is not in the public general version " + words(i + 500, 20)) for i in range(150)]
    docs = frame(spark, plain + [(1000 + i, words(i + 900, 30) + "\n" + notices[i % len(notices)]) for i in range(48)])
    model, kept, real = licences.train(docs, "doc_id", "text"), [], licences.cut_lineage
    monkeypatch.setattr(licences, "cut_lineage", lambda df: kept.append(df.count()) or real(df))
    got = licences.scan(docs, model).where("licence != 'none'").count()
    assert 30 <= got <= 48 and max(kept) < len(plain)
