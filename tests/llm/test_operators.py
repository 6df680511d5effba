"""The operators on planted cases: brute force, edge cases, and what must stay alone."""

import os
import random
import time
import tracemalloc
import zlib
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm import components, decontam, html_extract, jaccard_join, langid, license_scan, line_dedup, mixing, oracles, pii, quality, textkernel, url_filter
from quillon.llm import entry
from quillon.plans import lineage
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LATIN = "the of and ing tion er hand stone water light paper house river green quick small bright".split()
OTHER = "été çà où être près naïve garçon forêt château hôtel élève même âge très".split()


def prose(rng, n, words=LATIN):
    return " ".join(rng.choice(words) + rng.choice(words) * rng.randrange(2) for _ in range(n))


def planted():
    rng = random.Random(5)
    docs, items = [], [(k, prose(rng, 30)) for k in range(4)] + [(9, "Short item only"), (10, None), (11, ""), (3, prose(rng, 12))]
    for k in range(60):
        text = "\n".join(prose(rng, rng.randrange(3, 30), OTHER if k % 3 == 0 else LATIN).capitalize() for _ in range(rng.randrange(1, 9)))
        docs.append([k, text, "fr" if k % 3 == 0 else "en", f"s{k % 3}"])
    words = items[1][1].split()
    docs[4][1] += "\nBefore " + " ".join(words[5:17]).upper() + " after"  # a passage
    docs[5][1] += " ".join(words[5:14])  # one word short of a window
    docs[6][1] = "short ITEM, only!"
    docs[7][1] = docs[8][1] + " tail"  # near copies
    docs[10][1] = docs[11][1] = docs[12][1]  # exact copies
    long = prose(rng, 120).split()
    for k in range(13, 20):  # a group of near copies, each different
        own = list(long)
        own[k] = f"changed{k}"
        docs[k][1] = " ".join(own)
    for k in range(20, 40):  # a passage that many documents share
        docs[k][1] += "\n" + " ".join(long[:60])
    docs[41][1] = "Mail a.b@example.com, call +1 (555) 123-4567 or 4111 1111 1111 1111; host 10.0.0.255 and 1.2.3.256; é x@y.z IBAN DE89 3704 0044 0532 0130 00"
    docs[42][1], docs[43][1], docs[44][1], docs[45][1] = None, "", "   \n\t", "12 345 67"
    docs[46][1] = "word " * 40_000
    docs[47][1] = "a.b@c.d" + "\U0001f600 Ünï +12 345 678 9" * 30
    docs[48] = list(docs[47][:0]) + [48, docs[47][1], "en", None]
    for k in range(0, 60, 2):
        if docs[k][1] and k not in (42, 44):
            docs[k][1] += "\nShare this page with your friends"
    docs[51][1] = "Code\nReleased under the MIT License.\nlicensed under CC BY-NC 4.0"
    docs += [list(docs[50]), list(docs[42])]  # repeated rows
    return [(a, b, c, d, len(b or "")) for a, b, c, d in docs], items


DOCS, ITEMS = planted()


@pytest.fixture(scope="module")
def docs(spark):
    # Names that operators use inside.
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({"term": F.lit(1), "pos": F.lit("x"), "size": F.lit(2.5), "key": F.lit(None).cast("string"), "n": F.lit(7)}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def texts():
    return [d[:2] for d in DOCS]


def test_kernel_counts_words_and_shingles():
    column = pa.array([d[1] for d in DOCS], pa.string()).slice(1)
    for w in textkernel.words(column, fold=True):
        hashes, bounds = textkernel.grams(w, 5)
        for k, n in enumerate(w.counts):
            text = DOCS[1 + w.first + k][1]
            assert n == len(brute.WORD.findall(text or ""))
            assert len(np.unique(hashes[bounds[k] : bounds[k + 1]])) == len(brute.shingles(text))


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.digest(decontam.match_phrases(docs, items))
    want = sorted(brute.decontaminated(texts(), ITEMS), key=str)
    assert rows(got, *got.columns) == want
    assert {r[0] for r in want if r[-1]} >= {4, 6} and not next(r for r in want if r[0] == 5)[-1]
    assert decontam.match_phrases(docs, items.limit(0)).filter("size(hits) > 0").count() == 0
    assert decontam.match_phrases(empty, items).count() == 0


def near_ones(df):
    return {r.doc_id: set(r.near_items) for r in df.collect() if r.near_items}


def test_proximity(spark, docs, monkeypatch):
    words = ITEMS[1][1].split()
    moved, changed = list(words), list(words)
    random.Random(1).shuffle(moved)
    changed[4] = "another"
    put_in = [x for k, w in enumerate(words) for x in ([w, "extra"] if k % 8 == 7 else [w])]
    made = [(1, "filler " * 5 + " ".join(moved)), (2, "nothing here"), (3, None), (4, "so " + " ".join(put_in)), (5, " ".join(changed)), (6, " x y z ".join(words)), (7, ""), (4, "so " + " ".join(put_in))]
    made += [(8, " ".join(words[:15]) + " gap" * 4 + " " + " ".join(words[15:])), (9, " ".join(words[:15]) + " gap" * 6 + " " + " ".join(words[15:])), (10, " ".join(words) * 3)]
    items = [*ITEMS, (77, ITEMS[1][1])]
    want = dict(brute.nearby(made, items))
    assert {1, 4, 8} <= set(want) and not {2, 3, 5, 6, 9} & set(want) and want[4] == {"1", "77"}
    frame = spark.createDataFrame(made, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert near_ones(decontam.match(frame, bench)) == want
    monkeypatch.setattr(decontam, "SPAN", 2)  # salted postings give the same
    assert near_ones(decontam.match(frame, bench)) == want
    got = decontam.digest(decontam.match(docs, bench)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(got, *got.columns) == sorted(brute.decontaminated(texts(), items), key=str)
    assert near_ones(decontam.match(docs, bench)) == dict(brute.nearby(texts(), items))
    assert near_ones(decontam.match(frame, bench.limit(0))) == {}


def test_shuffled_joins_give_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for module in (line_dedup,):
        monkeypatch.setattr(module, "BROADCAST_BYTES", -1)
    monkeypatch.setitem(lineage.sized_join.__kwdefaults__, "limit", -1)
    monkeypatch.setattr(lineage, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(mixing, "QUOTA_BYTES", -1)
    broadcasts = []
    monkeypatch.setattr(lineage.F, "broadcast", lambda df: broadcasts.append(df) or df)
    got = decontam.digest(decontam.match_phrases(docs, items))
    assert rows(got, *got.columns) == sorted(brute.decontaminated(texts(), ITEMS), key=str)
    out = line_dedup.line_dedup(docs)
    assert rows(out, "doc_id", "n_lines", "n_dropped", "text") == sorted(brute.deduped_lines([(a, b, d) for a, b, _, d, _ in DOCS]), key=str)
    plan = {r.doc_id: (r.target, r.taken) for r in mixing.mix(docs.filter("doc_id not in (42, 50)")).collect()}
    assert not broadcasts
    monkeypatch.undo()
    assert plan == {r.doc_id: (r.target, r.taken) for r in mixing.mix(docs.filter("doc_id not in (42, 50)")).collect()}


def test_line_dedup(docs, empty):
    want = sorted(brute.deduped_lines([(a, b, d) for a, b, _, d, _ in DOCS]), key=str)
    assert sum(r[2] for r in want) >= 20
    assert rows(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "text") == want
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_by_host(spark):
    pages = [(k, f"http://{'A' if k % 2 else 'b'}.com/{k}", f"Menu {k % 2}\nText {k}") for k in range(40)] + [(99, None, "Menu 0"), (98, "no scheme", None)]
    got = line_dedup.dedup_by_host(spark.createDataFrame(pages, "page_id long, url string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_lines", "n_dropped"]
    assert {r.page_id: r.text for r in got.collect()} == {k: (f"Text {k}" if k < 40 else t) for k, _, t in pages}


def test_license_scan(docs, empty):
    want = sorted(brute.licensed(texts(), license_scan.TEMPLATES), key=str)
    got = license_scan.license_scan(docs)
    assert rows(got, "doc_id", "license_id", "dice", "n_license_lines") == want
    assert next(r for r in want if r[0] == 51)[3] == 2
    assert license_scan.license_scan(empty).count() == 0


def test_license_scan_finds_wrapped_and_shared_lines(spark):
    wrapped = {}
    for name, text in license_scan.TEMPLATES:
        words = text.split()
        wrapped.setdefault(name, []).append("\n".join("# " + " ".join(words[k : k + 6]) for k in range(0, len(words), 6)))
    cases = [(name, f"Some code\n{x}\nmore words here", len(x.split("\n"))) for name, texts in wrapped.items() for x in texts]
    cases += [("proprietary", "Copyright (c) 2020 Example Ltd. All rights reserved.", 1), ("MIT", "This tool is open source. Released under the MIT License. Enjoy", 1)]
    cases += [(None, "all the rights were reserved by the software license of the public domain", 0), (None, "the license\nunder the terms", 0), ("MIT", "Released under the MIT License.\nReleased under\nthe MIT License.", 3)]
    docs = spark.createDataFrame([(k, x) for k, (_, x, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.n_license_lines) for r in license_scan.license_scan(docs).collect()}
    assert got == {k: (name, n) for k, (name, _, n) in enumerate(cases)}


def test_license_texts(spark):
    """Whole licence texts, wrapped as in files, with a name, a year and comment signs, at the start of code or alone, and long."""
    cases = []
    for name, text in license_scan.TEXTS:
        words = text.split()
        wrapped = "\n".join("# " + " ".join(words[k : k + 12]) for k in range(0, len(words), 12))
        cases += [(name, text), (name, f"Copyright (c) 2021 Some Body\n\n{wrapped}\n\nimport os\n" + "\n".join(f"x{k} = {k} * y" for k in range(300)))]
        cases.append((name, " ".join(w for k, w in enumerate(words) if k % 40)))  # some words are missing
    grant = license_scan._MIT_GRANT.split()
    cases += [(None, "word " * 200_000), (None, " ".join(sorted(license_scan.TEXTS[1][1].split()))), ("MIT", f"{' '.join(['so'] * 50_000)} {license_scan.TEXTS[0][1]}"), (None, " ".join(w for x in zip(grant, ["a b c d"] * len(grant)) for w in x))]
    docs = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    assert {k: r.license_id for k, r in got.items()} == {k: name for k, (name, _) in enumerate(cases)}
    assert all(got[3 * k].dice == 1.0 for k in range(len(license_scan.TEXTS))) and got[1].n_license_lines == got[1].text.count("# ")


def test_pii(docs, empty, spark):
    got = pii.find_pii(docs)
    digest = pii.digest(got)
    assert rows(digest, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(brute.personal(texts()), key=str)
    found = [tuple(e) for e in got.filter("doc_id = 41").first().entities]
    assert [e[0] for e in found] == ["email", "email", "ip", "card", "phone", "iban"]
    assert all(DOCS[41][1][e[1] : e[2]] == e[3] for e in found)
    assert next(e[4] for e in found if e[0] == "iban") == 1.0
    text = pii.redact(docs.filter("doc_id = 41")).first().text
    assert text.startswith("Mail <email>, call <phone> or <card>; host <ip> and 1.2.3.256") and text.endswith("IBAN <iban>")
    assert pii.find_pii(empty).count() == 0


def test_pii_random(spark):
    rng = random.Random(3)
    made = [(k, "".join(rng.choice("ab@.+-% 0123456789().é:\n1234") for _ in range(rng.randrange(80)))) for k in range(400)]
    cards = [(1000 + k, " ".join(str(rng.randrange(10**4)).zfill(4) for _ in range(4)) + rng.choice(["", " 12", "-3"])) for k in range(200)]
    got = pii.digest(pii.find_pii(spark.createDataFrame(made + cards, "doc_id long, text string")))
    assert rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(brute.personal(made + cards), key=str)


@pytest.mark.parametrize("run", ["7", ".", "a", "+", "7-", "7 ", "+1 ", "(", "1.", "a.", "a@b.", "a@b.c ", "+12345678 ", "1.2.3.4 ", "A1", "-"])
def test_pii_long_runs(spark, run):
    """A million characters of one kind, alone and before and after real matches: the same spans as the plain patterns."""
    long = (run * (1_000_000 // len(run) + 1))[:1_000_000]
    made = [(0, long), (1, f"x@y.zz {long} 10.0.0.1 and 4111 1111 1111 1111"), (2, f"{long}\n+1 555 123 4567")]
    got = pii.digest(pii.find_pii(spark.createDataFrame(made, "doc_id long, text string")))
    began = time.monotonic()
    found = {r.doc_id: r for r in got.collect()}
    assert time.monotonic() - began < 30
    few = [(k, x.replace(long, long[:600])) for k, x in made]
    short = pii.digest(pii.find_pii(spark.createDataFrame(few, "doc_id long, text string")))
    assert rows(short, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(brute.personal(few), key=str)
    ends = lambda r: [x.split(":")[0] for x in r.spans.split(",")][-3:]
    if run in ("7", ".", "a", "(", "A1"):
        assert ends(found[1]) == ["email", "ip", "card"] and found[2].n_phone >= 1


def test_jaccard_join(docs, empty):
    want = dict((r[0], r) for r in brute.jaccard(texts()))
    got = rows(jaccard_join.jaccard_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted((want[d[0]] for d in DOCS), key=str)
    assert want[7][2] == 7 and want[8][2] == 7 and {want[k][2] for k in range(13, 20)} == {13} and want[42][2] == 42
    assert jaccard_join.jaccard_components(empty).count() == 0
    kept = jaccard_join.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, r in want.items() if r[2] == k)


def edited(rng):
    base = [f"w{k}" for k in range(300)]
    made = []
    for k in range(60):  # windows that slide: neighbours link, far ones don't
        made.append((k, " ".join(base[k * 4 : k * 4 + 40])))
    for k in range(40):  # heavy edits of one text
        own = list(base[:80])
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(80)] = f"x{rng.randrange(30)}"
        made.append((100 + k, " ".join(own)))
    return made


@pytest.mark.parametrize(("pivots", "leaf", "group"), [(2, 2, 1), (3, 5, 7), (8, 32, 250)])
def test_jaccard_chains_and_thresholds(spark, monkeypatch, pivots, leaf, group):
    for name, value in (("PIVOTS", pivots), ("LEAF", leaf), ("GROUP", group)):
        monkeypatch.setattr(jaccard_join, name, value)
    made = edited(random.Random(8))
    got = rows(jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard(made), key=str)


@pytest.mark.parametrize("spread", [9, 30])
def test_jaccard_hot_cell(spark, monkeypatch, spread):
    """One passage is a large part of most documents, with tight groups of near copies around it: cells hold many documents of many
    components. Every path has work: regions that split, regions that stay whole, leaves; and what is measured stays far
    below all pairs of the cells."""
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    rng = random.Random(spread)
    passage, made = [f"p{k}" for k in range(120)], []
    for group in range(40):
        own = passage + [f"g{group}x{k}" for k in range(rng.choice([spread, 2 * spread]))]
        for _ in range(rng.randrange(1, 7)):
            words = list(own)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
            made.append((len(made), " ".join(words)))
    seen = []
    measured = jaccard_join._measured
    monkeypatch.setattr(jaccard_join, "_measured", lambda pairs, sets: seen.append(pairs.distinct().count()) or measured(pairs, sets))
    got = rows(jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard(made), key=str)
    assert len(seen) > 1 and sum(seen) < len(made) * (len(made) - 1) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_nested_groups(spark, monkeypatch, seed):
    """Groups within groups, at distances on both sides of the threshold: regions that split are joined again."""
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    rng, made = random.Random(seed), []
    for a in range(4):
        mid = [f"t{k}" for k in range(60)]
        for _ in range(5):
            mid[rng.randrange(60)] = f"a{a}_{rng.randrange(99)}"
        for b in range(5):
            low = list(mid)
            for _ in range(3):
                low[rng.randrange(60)] = f"b{a}_{b}_{rng.randrange(99)}"
            for _ in range(5):
                words = list(low)
                words[rng.randrange(60)] = f"c{rng.randrange(999)}"
                made.append((len(made), " ".join(words)))
    got = rows(jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard(made), key=str)


def test_often_counts(monkeypatch):
    monkeypatch.setattr(jaccard_join, "HELD", 50)
    rng, often, true = np.random.default_rng(3), jaccard_join._Often(), {}
    for _ in range(40):
        keys = np.unique(np.concatenate([rng.integers(0, 1 << 60, 90), rng.integers(0, 6, 4)])).astype(np.uint64)
        often.add(keys)
        for k in keys.tolist():
            true[k] = true.get(k, 0) + 1
    assert len(often.keys) <= 50
    held = dict(zip(often.keys.tolist(), often.counts.tolist()))
    bound = sum(true.values()) / 50
    assert all(true[k] - bound <= held.get(k, 0) <= true[k] for k in true) or all(held.get(k, 0) <= true[k] <= held.get(k, 0) + bound for k in true)
    assert all(held.get(k, 0) > 0 for k in true if true[k] > bound)


def test_jaccard_heavy_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HEAVY", 3)
    monkeypatch.setattr(jaccard_join, "LOCAL_HEAVY", 2)
    got = rows(jaccard_join.jaccard_components(spark.createDataFrame(texts(), "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    want = dict((r[0], r) for r in brute.jaccard(texts()))
    assert got == sorted((want[d[0]] for d in DOCS), key=str)


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 170)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 150: 150, 170: 150, 200: 150}


def test_language_id(spark, docs, empty):
    rng = random.Random(9)
    made = [(1000 + k, prose(rng, 40, OTHER if k % 2 else LATIN), "fr" if k % 2 else "en") for k in range(400)]
    labelled = spark.createDataFrame(made, "doc_id long, text string, lang string")
    net = langid.train(labelled.filter(~langid.held_out()))
    told = langid.identify(labelled, net).withColumn("held_out", langid.held_out()).collect()
    lang = {d[0]: d[2] for d in made}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in told)
    apart = [r for r in told if r.held_out]
    assert len(apart) > 100 and sum(r.lang_pred == lang[r.doc_id] for r in apart) / len(apart) > 0.97
    told = langid.identify(docs, net).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in told if r.doc_id in (42, 43, 44, 45))
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in told)
    again = langid.train(labelled.filter(~langid.held_out()))
    assert all(np.array_equal(net.p[k], again.p[k]) for k in net.p)
    assert langid.train(empty) is None
    # A text that a language repeats counts once, and does not keep the language from being learnt.
    one = spark.createDataFrame([(5, made[1][1], "fr")] * 5000 + [(6, made[0][1], "en")] + [(7, None, "en"), (8, "", "de"), (9, "12", "xx")], "doc_id long, text string, lang string")
    assert [(k, x[0]) for k, x in langid.training_sample(one, "text", "lang")] == [("en", made[0][1][: langid.WINDOW]), ("fr", made[1][1][: langid.WINDOW])]
    sample = langid.training_sample(labelled, "text", "lang", per_language=20)
    assert [k for k, _ in sample] == ["en"] * 20 + ["fr"] * 20
    assert sample == langid.training_sample(labelled.unionByName(labelled).repartition(7), "text", "lang", per_language=20)
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    whole = langid.identify(docs, net, keep=("text", "doc_id"))
    assert rows(whole, "doc_id", "text") == sorted(texts(), key=str)


def test_language_id_gradients():
    rng = np.random.default_rng(0)
    net = langid.ByteNet(["a", "b", "c"])
    windows, labels = rng.integers(1, 256, (6, langid.WINDOW), dtype=np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        z = net.logits(windows).astype(float)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(6), labels]).mean())

    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net._gradients(windows, labels)
    for name, at in (("o", (3, 1)), ("b", (2,)), ("f3", (5, 4)), ("e", (int(windows[0, 9]), 2))):
        old, eps = net.p[name][at], 1e-6
        net.p[name][at] = old + eps
        up = loss()
        net.p[name][at] = old - eps
        assert abs((up - loss()) / (2 * eps) - grads[name][at]) < 1e-4
        net.p[name][at] = old


URLS = [
    "https://www.a.example.org/es/1", "http://EXAMPLE.org/en/123?x=1", "http://example.org/en/2#t", "http://b.com/fr/9.html", "http://b.com/de/", "http://xcom/de/1", "ftp://org", "http://org/", "http://a.net/en/55?p=1&q=2",
    None, "", "no scheme", "http://é.com/de/ü", "http://a.com/de/1\n2", "://com/fr/", "http://b.com/fr?x://org/",
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(k, u, "verdict") for k, u in enumerate(URLS * 8)], "page_id long, url string, rule string")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == len(URLS) * 8
    rule = {r.page_id % len(URLS): (r.host, r.path, r.rule, r.verdict) for r in got}
    assert rule[0] == ("www.a.example.org", "/es/1", "example.org/es/", "block")
    assert rule[1] == ("example.org", "/en/123", "example.org/en/1", "block")
    assert rule[2][2:] == ("org/", "allow") and rule[3][2:] == ("com/fr/", "allow") and rule[4][2:] == ("com/de/", "block")
    assert rule[5][2] is None and rule[6] == ("org", "", None, rule[6][3]) and rule[7][2] == "org/" and rule[8][2] is None
    assert all(rule[k][:3] == ("", "", None) for k in (9, 10, 11))
    assert rule[13] == ("a.com", "/de/1\n2", "com/de/", "block") and rule[14] == ("com", "/fr/", "com/fr/", "allow") and rule[15][:3] == ("b.com", "/fr", None)
    assert {r.verdict for r in got} == {"allow", "block"}
    none = url_filter.filter_urls(pages.filter("url like 'no%'")).collect()
    assert {(r.verdict, r.score) for r in none} == {("allow", 0.0)}
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_rules_by_brute_force(spark):
    rng = random.Random(11)
    part = lambda: "".join(rng.choice(["org", "com", "example.", "EXAMPLE.org", "/", "/en/1", "/es/", "/fr/", "/de/", "?", "#", "://", ".", "a", "x1.html", "\n", "é"]) for _ in range(rng.randrange(7)))
    urls = [rng.choice(["http://", "", "://", "https://www.", "ftp"]) + part() for _ in range(600)] + [None, "http://" + "a" * 100_000 + ".com/de/"]
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute.ruled(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_url_sample_is_of_distinct_urls(spark):
    urls = [(f"http://{'bad' if k % 2 else 'fine'}{k}.org/{k}", "block" if k % 2 else "allow") for k in range(25)]
    labelled = spark.createDataFrame(urls * 400, "url string, verdict string")
    trees, blocked = url_filter.train(labelled, sample=20)
    host, path = url_filter.host_and_path(F.col("url"))
    classes = {r.url: (r.h, r.f) for r in labelled.distinct().select("url", *[c.alias(k) for k, c in zip("hf", url_filter.suffix_classes(host, path), strict=True)]).collect()}
    x = np.array([url_filter.features(u, *classes[u], blocked) for u, _ in urls])
    assert ((trees.score(x) >= 0.5) == [v == "block" for _, v in urls]).mean() >= 0.8
    assert np.array_equal(url_filter.train(labelled, sample=25)[0].score(x), url_filter.train(labelled, sample=1000)[0].score(x))


def test_trees_learn():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = url_filter.Trees().fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Home<li>News</ul></nav><div class='cookie-notice'>Cookies</div>{0}<aside>Side</aside><form>Mail<input></form><script>var x='</p>';</script><div id=comments><p>A comment</p></div><footer>&copy; X</footer>"
HTML = "page_id long, url string, html string"


def extracted(spark, made):
    return {r.page_id: (r.text, r.n_chars, r.n_shared) for r in html_extract.extract(spark.createDataFrame(made, HTML)).collect()}


def test_html_extract(spark):
    article = "<article><h1>Head &amp; more</h1><p>One <b>bo</b>ld&nbsp;\n two<br>three</p><div class=ad>Buy</div><ul><li>x<li>y</ul></article>"
    made = [(k, f"http://h.com/{k}", PAGE.replace("{0}", article)) for k in range(3)]
    made += [(10 + k, f"http://g.com/{k}", f"<p>Shared top</p><p>Own text {k}</p><p>Shared end</p>") for k in range(4)]
    made += [(20, "http://lone.com/", "<p>All mine"), (21, None, None), (22, "", ""), (23, "http://z.com", "<p>cut &am"), (24, "http://y.com", "a < b <!-- c --> <article>d")]
    got = extracted(spark, made)
    assert all(got[k][0] == "Head & more One bold two three x y" for k in range(3))
    assert all(got[10 + k] == (f"Own text {k}", 10, 2) for k in range(4))
    assert got[20] == ("All mine", 8, 0) and got[21][:2] == got[22][:2] == ("", 0) and got[23][0] == "cut &am" and got[24][0] == "d"
    assert html_extract.extract(spark.createDataFrame([], HTML)).count() == 0


def test_html_differencing_decides(spark):
    """What may be article text goes if the neighbour has it too; what no list knows goes by its place."""
    body = "<div class=zq><p>Changing chrome {k}</p></div><article><header><h1>Head {k}</h1></header><p>Same passage</p><div class=share>Share this</div><div class='related-work'><p>Work of {k}</p></div><p>E = <math><mi>m</mi><mi>c</mi></math>{k}</p></article>"
    alone = html_extract.main_text(html_extract.lines_of(body.replace("{k}", "1")), None)
    assert alone == ("Head 1 Same passage Share this Work of 1 E = mc1", 0)
    got = extracted(spark, [(k, f"http://h.com/a/{k}", body.replace("{k}", str(k))) for k in range(5)])
    assert all(got[k] == (f"Head {k} Same passage Work of {k} E = mc{k}", 37, 2) for k in range(5))
    plain = "<div class=top>Site {k}</div><div class=header>Date {k}</div><p>Text {k}</p><div class=header>End</div>"
    got = extracted(spark, [(k, f"http://h.com/{k}", plain.replace("{k}", str(k))) for k in range(3)])
    assert all(got[k] == (f"Site {k} Text {k}", 13, 2) for k in range(3))
    assert html_extract.main_text(html_extract.lines_of("<main>a<p class='with-sidebar'>b</p><noscript>c</noscript><object>d</object></main>e"), None)[0] == "a b cd"


def test_html_lines_as_a_parser_reads_them():
    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.blocks, self.raw = [""], 0

        def handle_starttag(self, tag, attrs):
            self.raw += tag in ("script", "style")
            self.blocks += [""] if tag in ("p", "div", "li", "article", "h1", "td") else []
            self.blocks[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.raw -= tag in ("script", "style")
            self.blocks += [""] if tag in ("p", "div", "li", "article", "h1", "td") else []

        def handle_data(self, data):
            self.blocks[-1] += "" if self.raw else data

    rng = random.Random(12)

    def some(depth):
        if depth > 3 or rng.random() < 0.3:
            return rng.choice(["word", " a  b\n", "x &lt; y &amp;", "&eacute;&#8364;", "<br>", "<!-- <p>no</p> -->", "<script>if (a<b) '</p>'</script>", "<img alt='a>b'>", "1 &gt; 0"])
        tag = rng.choice(["p", "div", "li", "td", "b", "em", "span", "h1", "custom-tag"])
        return f"<{tag}{rng.choice(['', ' title=\"a b\"', ' data-x=1'])}>" + "".join(some(depth + 1) for _ in range(rng.randrange(4))) + f"</{tag}>"

    for _ in range(200):
        page = "".join(some(0) for _ in range(6))
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert [x.text for x in html_extract.lines_of(page)] == [" ".join(b.split()) for b in reader.blocks if b.split()]


def test_html_neighbours_by_brute_force(spark):
    """Hosts of several sizes, a hot one, at several numbers of partitions: every page against the neighbour that sorting all
    pages finds, by a plain alignment."""
    rng = random.Random(4)
    made = []
    for k in range(240):
        host = "hot.com" if k % 3 else f"h{k % 40}.com"
        own = [f"<p>own {k} {j}</p>" for j in range(rng.randrange(3))]
        menu = [f"<p>menu {host} {j}</p>" for j in range(6) if rng.random() < 0.7]
        made.append((k, f"http://{host}/{rng.choice('abc')}/{rng.choice('xyz')}{k}?q=1", "".join(menu[:2] + own[:1] + menu[2:] + own[1:])))
    lines = {k: [x.text for x in html_extract.lines_of(h)] for k, _, h in made}
    order = sorted((u.split("/")[2], u.split("?")[0].split(".com", 1)[1], k) for k, u, _ in made)

    def common(a, b):
        return len(os.path.commonprefix([a, b]))

    want = {}
    for i, (host, path, k) in enumerate(order):
        near = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order) and order[j][0] == host]
        other = lines[max(near, key=lambda x: common(x[1], path))[2]] if near else []
        assert [x for x in lines[k] if x in other] == [x for x in other if x in lines[k]]  # distinct lines in one order
        left = [x for x in lines[k] if x not in other]
        want[k] = (" ".join(left), len(" ".join(left)), len(lines[k]) - len(left))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "4", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert extracted(spark, made) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_html_repeats_long_pages_and_names(spark):
    long = "".join(f"<p>line {k}" for k in range(60_000))
    made = [(k, "http://same.com/x", "<p>Same") for k in range(6)] + [(10, "http://long.com/1", long + "<p>one"), (11, "http://long.com/2", long + "<p>two"), (12, "http://long.com/3", "<div>" * 50_000 + "</x>" * 50_000 + "deep")]
    began = time.monotonic()
    got = extracted(spark, made)
    assert time.monotonic() - began < 60
    assert all(got[k] == ("", 0, 1) for k in range(6)) and got[10] == ("one", 3, 60_000) and got[12][0] == "deep"
    names = ("text", "n_chars", "_host", "_part", "_html", "host")
    pages = spark.createDataFrame([(k, f"http://h.com/{k}", f"<p>a</p><p>{k}</p>", *names) for k in range(3)], ["page_id", "url", "html", *names])
    out = html_extract.extract(pages, keep=("page_id", *names))
    assert out.columns == ["page_id", "_host", "_part", "_html", "host", "text", "n_chars", "n_shared"]
    assert rows(out, "page_id", "_host", "host", "text") == [(k, "_host", "host", str(k)) for k in range(3)]


def test_shared_lines(monkeypatch):
    rng = random.Random(2)
    for bits, block in ((1 << 22, 1 << 12), (8, 1 << 12), (8, 3), (30, 1)):
        monkeypatch.setattr(html_extract, "TABLE_BITS", bits)
        monkeypatch.setattr(html_extract, "BLOCK", block)
        for _ in range(300):
            a, b = ([rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(2))
            table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            found, left = sorted(html_extract.shared_lines(a, b)), iter(b)
            assert len(found) == table[-1][-1] and all(a[k] in left for k in found)


def test_shared_lines_of_long_pages_take_little_memory():
    """10^5 lines, most of them different, some often repeated, in another order here and there."""
    rng = random.Random(6)
    a = [f"line {k}" if k % 5 else f"often {k % 7}" for k in range(100_000)]
    b = list(a)
    for _ in range(300):
        k = rng.randrange(99_000)
        b[k : k + 50] = reversed(b[k : k + 50])
    tracemalloc.start()
    began = time.monotonic()
    found = html_extract.shared_lines(a, b)
    assert time.monotonic() - began < 120 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert 85_000 < len(found) < 100_000


def test_mixing(docs, empty):
    want, source = brute.targets([(a, b, d) for a, b, _, d, _ in DOCS]), {d[0]: d[3] for d in DOCS}
    got = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in DOCS)
    taken = {}
    for r in got:
        assert (r.source_size, round(r.target, 6)) == (want[source[r.doc_id]][0], round(want[source[r.doc_id]][1], 6))
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    for s, (size, target) in want.items():
        longest = max(len(brute.WORD.findall(d[1] or "")) for d in DOCS if d[3] == s)
        assert abs(taken[s] - target) <= max(3, longest / 2 if longest > size / 4 else 3)
    assert rows(mixing.mix(docs), "doc_id", "taken") == rows(mixing.mix(docs), "doc_id", "taken")
    assert mixing.mix(empty).count() == 0


def test_budget_fit_is_best():
    rng = np.random.default_rng(6)
    for _ in range(200):
        sizes = np.unique(rng.integers(0, 30, rng.integers(1, 7)))
        counts = rng.integers(1, 4, len(sizes))
        total = int((sizes * counts).sum())
        budget = int(rng.integers(0, total + 1))
        sums = {0}
        for s, c in zip(sizes, counts, strict=True):
            sums = {x + int(s) * k for x in sums for k in range(int(c) + 1)}
        taken = mixing.fit(sizes, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert abs(int((sizes * taken).sum()) - budget) == min(abs(x - budget) for x in sums)


def test_budget_fit_of_large_sizes():
    """Documents far beyond the programme's table, and many of every size: near the budget, in bounded memory."""
    huge = np.array([3, 90_000, 10_000_000])
    for budget in (5, 80_000, 9_000_000, 12_345_678, 31_000_000):
        taken = mixing.fit(huge, np.array([2, 5, 3]), budget)
        assert abs(int((huge * taken).sum()) - budget) <= 5_000_000
    sizes, counts = np.arange(2, 60_000, 2), np.full(29_999, 3)
    for budget in (40_001, 10**9 + 1):
        taken = mixing.fit(sizes, counts, budget)
        assert (taken <= counts).all() and abs(int((sizes * taken).sum()) - budget) <= 1


def test_mixing_carries_clashing_names(spark):
    names = ("size", "n", "bucket", "target", "times", "some", "copies", "taken", "source_size", "more", "_text", "_keep_0")
    rows_ = [(k, f"word {'x ' * k}", f"s{k % 2}", *(f"{c}{k}" for c in names)) for k in range(12)]
    got = mixing.mix(spark.createDataFrame(rows_, ["doc_id", "text", "source", *names]), keep=("doc_id", "text", "source", *names))
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken", "text", "n", "bucket", "times", "some", "more", "_text", "_keep_0"]
    for r in got.collect():
        assert r["size"] == r.doc_id + 1 and all(r[c] == f"{c}{r.doc_id}" for c in ("n", "bucket", "times", "some", "more", "_text", "_keep_0")) and r.text == f"word {'x ' * r.doc_id}"


def test_shares_stop_at_twice_the_size():
    assert mixing.share_out([10, 100, 100], [3, 1, 2], 315, 2) == pytest.approx([20, 295 / 3, 590 / 3])
    assert mixing.share_out([0, 4], [3, 1], 6, 2) == [0, 6]


def test_quality(docs, empty):
    got = quality.quality_cascade(docs)
    assert rows(got, "doc_id", *quality.COUNTS, "base_failed") == sorted(brute.quality(texts()), key=str)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert not kept[42] and not kept[46] and kept[13]
    assert kept == brute.kept(texts())
    assert quality.quality_cascade(empty).count() == 0
    words = " ".join(f"w{k}" for k in range(60))
    column = pa.array([" ".join(f"{w}***" for w in words.split()), words])
    bad, fine = quality.counted(column)
    assert quality.RULES["symbols"](column[0].as_py(), dict(zip(quality.COUNTS, bad, strict=True)))
    assert not any(rule(words, dict(zip(quality.COUNTS, fine, strict=True))) for rule in quality.RULES.values())


def test_quality_rules_by_brute_force(spark):
    rng = random.Random(21)
    parts = ["word", "a", "incomprehensibilities-of-it", "###", "12", "|", "\n", "\n- ", "\n\u2022", "...\n", "\u2026 \n", "line one\nline one\n", "\u00a0", "* ", "été"]
    made = [(k, " ".join(rng.choice(parts[: rng.randrange(1, len(parts) + 1)]) + str(rng.randrange(40)) * rng.randrange(2) for _ in range(rng.randrange(40, 160)))) for k in range(500)]
    made += [(k, " ".join(f"{rng.choice(parts)}" + f"w{j}" for j in range(80))) for k in range(500, 700)]
    got = quality.quality_cascade(spark.createDataFrame(made, "doc_id long, text string"))
    want = brute.kept(made)
    assert {r.doc_id: r.kept for r in got.collect()} == want and 20 < sum(want.values()) < 690
    assert rows(got, "doc_id", *quality.COUNTS, "base_failed") == sorted(brute.quality(made), key=str)
    order = quality.ordered_rules(spark.createDataFrame(made, "doc_id long, text string"))
    rates = [x[2] / max(x[1], 1e-9) for x in order]
    assert {x[0] for x in order} == set(quality.RULES) and rates == sorted(rates, reverse=True) and any(x[2] > 0 for x in order)


def test_pipeline(spark, docs, empty, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(DOCS, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "mixing"]
    left, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    told = {r.doc_id: r.lang_pred for r in langid.identify(left, langid.train(left.filter(~langid.held_out()))).collect()}
    want = [d for d in DOCS if told[d[0]] != "und"]
    first = corpus_pipeline.language_id(spark, left, str(tmp_path))
    assert first.columns == columns
    assert sorted(r.doc_id for r in first.collect()) == sorted(d[0] for d in want)
    left = first.cache()
    held = [(r.doc_id, r.text, r.source) for r in left.collect()]
    want = {(a, t) for a, _, n, t in brute.deduped_lines(held) if not n or brute.WORD.search(t)}
    left = corpus_pipeline.dedup_lines(spark, left, str(tmp_path)).cache()
    assert {(r.doc_id, r.text) for r in left.collect()} == want and left.columns == columns
    held = [(r.doc_id, r.text) for r in left.collect()]
    left = corpus_pipeline.near_duplicates(spark, left, str(tmp_path)).cache()
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in brute.jaccard(held)}) and left.columns == columns
    held = [(r.doc_id, r.text) for r in left.collect()]
    left = corpus_pipeline.decontaminate(spark, left, str(tmp_path)).cache()
    assert sorted(r.doc_id for r in left.collect()) == sorted(r[0] for r in brute.decontaminated(held, ITEMS) if not r[-1]) and left.columns == columns
    last = corpus_pipeline.mix_sources(spark, left, str(tmp_path))
    assert last.columns == [*columns, "size", "copies", "taken"]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert rows(whole, *whole.columns) == rows(last, *whole.columns)
    assert corpus_pipeline.mix_sources(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_keeps_the_documents_columns(spark, tmp_path):
    """Columns that are called like results or inner columns come through every stage but the last one's results."""
    names = ["lang_pred", "score", "Score2", "n_lines", "n_dropped", "n_words", "hits", "hit_items", "_id", "_site", "_text", "rank", "with.dot", "size", "source_size", "component_id"]
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame([(*d, *(f"{c}{d[0]}" for c in names)) for d in DOCS], ", ".join([SCHEMA, *(f"`{c}` string" for c in names)]))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = lineage.cut(stage(spark, left, str(tmp_path)), name)
        assert left.columns == frame.columns
    before = lineage.written()
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.columns == [c for c in frame.columns if c not in ("size", "copies", "taken")] + ["size", "copies", "taken"]
    held = [r.asDict() for r in last.collect()]
    assert held and all(r[c] == f"{c}{r['doc_id']}" for r in held for c in names if c != "size")
    assert len(lineage.written()) == len(before) + 1


def test_pipeline_keeps_every_text_with_a_language(spark, docs, tmp_path, monkeypatch):
    unsure = lambda df, net, keep: df.select(*keep).withColumns({"lang_pred": F.when(F.col("text").rlike("[a-z]"), "en").otherwise("und"), "score": F.lit(0.3)})
    monkeypatch.setattr(langid, "train", lambda df: None)
    monkeypatch.setattr(langid, "identify", unsure)
    kept = corpus_pipeline.language_id(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d[0] for d in DOCS if d[1] and any("a" <= c <= "z" for c in d[1]))


CONTRACT = {
    "op1_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op2_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_license_scan": {"doc_id": "bigint", "license_id": "string", "dice": "double", "n_license_lines": "bigint"},
    "op5_line_dedup": {"doc_id": "bigint", "source": "string", "n_lines": "bigint", "n_dropped": "bigint", "n_kept_chars": "bigint", "text_sha256": "string"},
    "op6_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op8_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op10_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
}
SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sample(spark):
    documents = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").select("item_id", "text").collect()]
    return documents, [d[:2] for d in documents], items


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_entries_give_the_contracts_rows(spark, sample, name):
    """Each registered query on a whole sample table: the contract's columns and types, a row for each of the table's, and the rows
    of the plain versions, or of the SQL."""
    documents, plain, items = sample
    got = entry.queries()[name](spark, SAMPLE).cache()
    kinds = dict(got.dtypes)
    assert {k: kinds.get(k) for k in CONTRACT[name]} == CONTRACT[name]
    pages = spark.read.parquet(f"{SAMPLE}/pages.parquet").collect()
    key = got.columns[0]
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r.page_id for r in pages) if key == "page_id" else sorted(d[0] for d in documents)
    want = {
        "op2_decontaminate": lambda: brute.decontaminated(plain, items), "op6_jaccard_join": lambda: brute.jaccard(plain),
        "op7_pii": lambda: brute.personal(plain), "op10_quality": lambda: ((*x, k) for x, k in zip(brute.quality(plain), brute.kept(plain).values(), strict=True)),
        "op1_url_filter": lambda: ((r.page_id, *brute.ruled(r.url)[:3]) for r in pages),
    }
    if name in want:
        columns = {"op7_pii": 6, "op1_url_filter": 4}.get(name, len(CONTRACT[name]))
        assert rows(got, *list(CONTRACT[name])[:columns]) == sorted(map(tuple, want[name]()), key=str)
    if name == "op2_decontaminate":
        assert {r.doc_id: set(r.near_items.split(",")) for r in got.collect() if r.near_items} == dict(brute.nearby(plain, items))
    if name == "op9_mix":
        targets, source = brute.targets(documents), {d[0]: d[2] for d in documents}
        assert all((r.source_size, round(r.target, 6)) == (targets[source[r.doc_id]][0], round(targets[source[r.doc_id]][1], 6)) and r.taken <= 2 * r["size"] for r in got.collect())
    if name in oracles.SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"create view {t} as select * from '{SAMPLE}/{t}.parquet'")
        told = con.sql(oracles.SQL[name]).df()
        assert sorted(told.columns) == sorted(got.columns)
        null = lambda v: None if v is None or v != v else v
        assert rows(got, *got.columns) == sorted((tuple(null(v) for v in r) for r in told[got.columns].astype(object).itertuples(index=False, name=None)), key=str)


def test_language_id_on_held_out_documents(spark):
    told = {r.doc_id: r for r in entry.op3_language_id(spark, SAMPLE).collect()}
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()}
    apart = [k for k, r in told.items() if r.held_out and true[k] is not None and r.lang_pred != "und"]
    assert len(apart) > 30 and sum(told[k].lang_pred == true[k] for k in apart) / len(apart) > 0.9


def test_entries_are_ten():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and set(names) == set(CONTRACT) and set(oracles.SQL) <= set(names)
