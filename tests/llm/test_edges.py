"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for operators and stages."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm import brute
from tidewatch.llm import chat, licences, packing, pii, quality, simhash, substrings, warc, wavelet, wumanber
from tidewatch.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, counts string, found string, quality string, matches string, known string"
LONG = " ".join(f"w{i % 977}x{i % 1301}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, f"before it {PASSAGE} and after"), (7, f"elsewhere {PASSAGE} ends"),
    (8, "same text here " * 30), (8, "same text here " * 30), (9, "Ünï " * 60), (None, f"no id {PASSAGE}"), (10, "a  b c   d\x1ce"),
]


@pytest.fixture(scope="module")
def docs(spark):
    made = [(i, t, None if i == 4 else "en", None if i == 5 else "s", None, "c", "f", "q", "m", "k") for i, t in TEXTS]
    return spark.createDataFrame(made, COLUMNS)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(f"shared{i}" for i in range(12))), (2, None), (3, ""), (4, "One!"), (5, "shared59 and"), (5, "shared59 and")], "item_id long, text string")


def test_quality(docs, nothing):
    got = {(r["doc_id"], r["quality_"]["n_words"], r["quality_"]["kept"]) for r in quality.judged(docs, docs.columns, "quality_").collect()}
    assert (1, 0, False) in got and (2, 0, False) in got and (5, 60_000, True) in got
    assert quality.judged(docs, docs.columns, "quality_").count() == len(TEXTS)
    assert quality.keep_good(nothing).count() == 0 and quality.keep_good(docs).columns == docs.columns


def test_sketches_merge_and_fences_stand_in(spark):
    rows = [(i, " ".join(f"word{i}{j}" for j in range(60)) + (" ### ### ###" * 20 if i % 50 == 0 else ""), "en", f"s{i % 3}" if i > 9 else "rare") for i in range(400)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"], "q").collect()
    assert {r["doc_id"] for r in got if not r["q"]["kept"]} == {i for i in range(400) if i % 50 == 0}


def test_simhash(docs, nothing):
    rows = [(i, t) for i, t in dict(TEXTS).items() if i is not None]
    roots = brute.reach({i: brute.fingerprint(t) for i, t in rows})
    got = {r["doc_id"]: (simhash_hex(r["fingerprint"]), r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    want = {i: (f"{brute.fingerprint(t):016x}", roots[i]) for i, t in rows}
    assert got == {**want, None: (f"{brute.fingerprint(dict(TEXTS)[None]):016x}", None)}
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(docs).where("doc_id = 8").count() == 2


def test_one_of_each_keeps_rows_without_an_id(docs):
    assert simhash.one_of_each(docs).where("doc_id IS NULL").collect() == docs.where("doc_id IS NULL").collect()


def test_rows_without_an_id_are_members(spark):
    rows = [(None, "same text here " * 30), (7, "same text here " * 30), (5, "same text here " * 30), (None, "alone it stands " * 30)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (7, 5)]
    clash = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, stay_id int")
    assert simhash.one_of_each(clash).where("doc_id IS NOT NULL").count() == 1


def simhash_hex(value):
    return f"{value & (1 << 64) - 1:016x}"


def test_dense_fingerprints_over_several_blocks(spark, monkeypatch):
    """A ball of fingerprints larger than a block: components are exact."""
    import numpy as np

    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    prints = {0}
    for _ in range(150):
        near = sorted(prints)[rng.integers(len(prints))]
        prints.add(near ^ int(sum(1 << int(b) for b in rng.choice(64, 3, replace=False))))
    prints |= {int(x) for x in rng.integers(0, 2**63, 50)}
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    rooted = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in simhash.components(simhash.links(frame)).collect()}
    want = brute.reach(dict(zip(sorted(prints), sorted(prints), strict=True)))
    groups = lambda of: {frozenset(k for k in prints if of(k) == r) for r in {of(k) for k in prints}}
    assert groups(lambda k: rooted.get(k, k)) == groups(want.__getitem__)


def test_tokens(docs, nothing):
    got = sorted((r["n_tokens"], r["ids_crc32"]) for r in wavelet.token_documents(docs, vocabulary(BYTE_VOCABULARY)).collect())
    want = sorted(x[2:4] for x in brute.tokens([(i or 0, t) for i, t in TEXTS], vocabulary(BYTE_VOCABULARY), 0))
    assert got == want and wavelet.token_documents(nothing, vocabulary(BYTE_VOCABULARY)).count() == 0


def test_wavelet_matrix():
    import numpy as np

    ids = np.random.default_rng(3).integers(0, 700, 9000)
    matrix = wavelet.WaveletMatrix.read(b"".join(wavelet.WaveletMatrix.build(ids).chunks()))
    assert (matrix.decode() == ids).all()
    assert [matrix.access(i) for i in (0, 1, 4095, 8999)] == [ids[i] for i in (0, 1, 4095, 8999)]
    for value in (0, 5, 699, 700, 5000):
        places = np.flatnonzero(ids == value).tolist()
        assert matrix.count(value) == len(places) and matrix.count(value, 5000) == sum(p < 5000 for p in places)
        assert [matrix.occurrence(value, k) for k in range(len(places))] == places


def test_packing(docs, nothing):
    pieces = packing.pack_documents(docs, vocabulary(WORD_VOCABULARY), 2)
    assert pieces.agg(F.sum("length")).first()[0] == sum(x[2] for x in brute.tokens([(i or 0, t) for i, t in TEXTS], vocabulary(WORD_VOCABULARY), 2))
    assert packing.pack_documents(nothing, vocabulary(WORD_VOCABULARY), 2).count() == 0
    assert packing.sequences(pieces).where("octet_length(ids) <> 4 * length").count() == 0


def test_first_fit_decreasing():
    assert packing.pack([3, 5, 2, 8, 10], room=10) == [(4, 0, 10, 0, 0), (3, 0, 8, 1, 0), (2, 0, 2, 1, 8), (1, 0, 5, 2, 0), (0, 0, 3, 2, 5)]
    tree = packing.TournamentTree(4, 10)
    assert [tree.place(n) for n in (7, 5, 3, 5, 10)] == [0, 1, 0, 1, 2]


def test_decontamination(docs, nothing, items):
    got = {r["doc_id"]: (r["found_"]["n_words"], r["found_"]["items"]) for r in wumanber.find_windows(docs, items, "found_").collect()}
    assert got[1] == (0, []) and got[4] == (1, ["4"]) and got[6] == (64, ["1", "5"]) and got[7] == (62, ["1"])
    assert wumanber.find_windows(nothing, items, "found_").count() == 0
    assert wumanber.without_contaminated(docs, items.limit(0)).count() == len(TEXTS)


def test_items_without_an_id_hit(docs, items):
    nameless = items.where("item_id = 1").selectExpr("CAST(NULL AS long) AS item_id", "text")
    got = {r["doc_id"]: (r["hit"], r["items"]) for r in wumanber.find_windows(docs, nameless, "found_").select("doc_id", wumanber.hit_words("found_").alias("hit"), "found_.items").collect()}
    assert got[6] == (12, []) and got[7] == (12, []) and got[4] == (0, [])
    kept = {r["doc_id"] for r in wumanber.without_contaminated(docs, nameless).select("doc_id").collect()}
    assert 4 in kept and not {6, 7} & kept


def test_decontamination_in_blocks(docs, items, monkeypatch):
    whole = sorted(map(str, wumanber.find_windows(docs, items, "found_").select("doc_id", "found_").collect()))
    monkeypatch.setattr(wumanber, "BLOCK_BYTES", 8)
    assert sorted(map(str, wumanber.find_windows(docs, items, "found_").select("doc_id", "found_").collect())) == whole


def test_substrings(docs, nothing):
    rows = [(i, t) for i, t in dict(TEXTS).items() if i is not None]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect())
    assert got == brute.repeats(rows)
    removed = {(r["doc_id"], r["n_removed"]) for r in substrings.without_repeats(docs).collect()}
    assert (None, 0) in removed and (6, 60) in removed and (7, 60) in removed and (8, 0) in removed
    assert substrings.without_repeats(nothing).count() == 0


def test_pseudonyms(spark, nothing, docs):
    text = "card 4111 1111 1111 1111, again 4111111111111111, not 4111111111111112; born 1980-02-29 or 29.02.1980 or 02/29/1980, not 2023-02-30; ssn 123-45-6789; ip 10.0.0.255 not 10.0.0.256; mail a.b@c.org; +1 (212) 555-0100 and 212-555-0100; 2099-12-30"
    frame = spark.createDataFrame([(1, text, "x"), (2, text, "x"), (3, None, "x"), (4, "", "x")], "doc_id long, text string, matches string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(frame, "found", "k").collect()}
    new = got[1]["text"]
    assert got[2]["text"] == new and got[3]["text"] is None and got[4]["text"] == ""
    cards = re.findall(r"card ([0-9 ]+), again ([0-9]+), not 4111111111111112", new)[0]
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111" and len(cards[0].split(" ")) == 4
    y, a, b = re.findall(r"born ([0-9-]+) or ([0-9.]+) or ([0-9/]+), not 2023-02-30", new)[0]
    assert y != "1980-02-29" and a == ".".join(reversed(y.split("-"))) and b == "/".join((y[5:7], y[8:], y[:4]))
    assert "123-45-6789" not in new and "10.0.0.255" not in new and "10.0.0.256" in new and "a.b@c.org" not in new
    p, q = re.findall(r"\+1 \((\d{3})\) (\d{3}-\d{4}) and (\S+);", new)[0][:2], re.findall(r"and (\d{3}-\d{3}-\d{4});", new)[0]
    assert "-".join(p) == q != "212-555-0100"
    assert got[1]["found"].asDict() == {"email": 1, "secret": 0, "ip": 1, "date": 4, "phone": 2, "ssn": 1, "card": 2}
    assert pii.pseudonymised(nothing, "found_", "k").count() == 0
    assert pii.pseudonymised(docs, "found_", "k").where("text <=> 'one'").count() == 1


def test_pseudonyms_beside_other_digits(spark):
    cases = {
        "order 12 4111 1111 1111 1111": ("card", "4111 1111 1111 1111"), "2024 4111 1111 1111 1111": ("card", "4111 1111 1111 1111"),
        "4111111111111111 12/27": ("card", "4111111111111111"), "4111 1111 1111 1111 123": ("card", "4111 1111 1111 1111"),
        "4111111111111111 555-123-4567": ("card phone", "4111111111111111 555-123-4567"), "12345 2024-01-05": ("date", "2024-01-05"),
        "123 555-123-4567": ("phone", "555-123-4567"), "1234567 078-05-1120": ("ssn", "078-05-1120"),
        "4111111111111111 12/27/2024": ("card date", "4111111111111111 12/27/2024"), "123-45-6789-4111-1111-1111-1111": ("ssn card", "123-45-6789 4111-1111-1111-1111"),
        "4111 1111 1111 1111 5500 0000 0000 0004 1 2 3": ("card card", "4111 1111 1111 1111"), "378282246310005 4111-1111-1111-1111 9": ("card card", "378282246310005"),
        "7 41111 11111 111111 7": ("card", "41111 11111 111111"), "555 123 2024-01-05": ("date", "2024-01-05"),
        "TOKEN = abcdefgh12345678": ("secret", "abcdefgh12345678"), "Password: 'hunter2hunter2'": ("secret", "hunter2hunter2"),
        "1 2 3 4 5 6 7 8 9 0 1 2 3 4111x": ("", ""), " ".join(["10"] * 3_000): (None, "nothing"),
    }
    frame = spark.createDataFrame([(t,) for t in cases], "text string").withColumn("was", F.col("text"))
    for r in pii.pseudonymised(frame, "found", "k").collect():
        kinds, gone = cases[r["was"]]
        if kinds is not None:
            assert sorted(k for k, n in r["found"].asDict().items() for _ in range(n)) == sorted(kinds.split()), r
        assert re.sub("[0-9A-Za-z]", "", r["was"])[:20] == re.sub("[0-9A-Za-z]", "", r["text"])[:20] or "secret" in kinds
        assert all(x not in r["text"] for x in gone.split(" ") if len(x) > 7) and (not gone or gone not in r["text"])


def test_pseudonyms_of_very_long_texts(spark):
    """A million characters for each pattern, and a hundred thousand findings in one text, in linear work."""
    long = ["a@b" + ".c" * 500_000, "a" * 1_000_000, "a@" * 400_000, "1 " * 400_000, "1-" * 400_000, "4111 1111 1111 1111 " * 50_000, "token=" + "x" * 1_000_000, "1.2.3." * 170_000,
            "2024-01-0" * 110_000, "(" * 1_000_000, "+1 " * 300_000, "9" * 1_000_000]
    many = " ".join(f"10.{i >> 16 & 255}.{i >> 8 & 255}.{i & 255}" for i in range(100_000))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*long, many])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(frame, "found", "k").select("doc_id", "found", F.length("text").alias("n"), F.size(F.array_distinct(F.split("text", " "))).alias("different")).collect()}
    assert got[0]["found"]["email"] == 1 and got[5]["found"]["card"] == 50_000 and got[6]["found"]["secret"] == 1
    assert got[len(long)]["found"]["ip"] == 100_000 and got[len(long)]["different"] == 100_000


def test_permutation_is_one_to_one(spark):
    made = spark.range(70).select(pii.permuted(F.col("id"), F.lit(7).cast("long"), F.lit(10).cast("long"), "t", "k").alias("p"))
    assert sorted(r["p"] for r in made.collect()) == list(range(70))


def test_licences(spark, nothing):
    frame = spark.createDataFrame([
        (1, "Text.\nReleased under the MIT License. More."), (2, None), (3, ""),
        (4, "Redistribution and use in source and binary forms are permitted: Redistributions of source code must retain the above copyright notice. Redistributions in binary form must reproduce the above copyright notice."),
        (5, "Redistributions in binary form must reproduce the above copyright notice. Redistribution and use in source and binary forms are permitted."),
        (6, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."),
    ], "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.recognised(frame).collect()}
    assert got == {1: ["MIT"], 2: [], 3: [], 4: ["BSD-2-Clause"], 5: [], 6: ["Apache-2.0", "CC-BY-NC-4.0"]}
    assert licences.recognised(nothing).count() == 0


def test_chat(spark):
    odd = ["</s>", "<\\/s>", "<\\\\/s>", "<", "[INST]<s>[/INST] [END]", "", None, "\\", "<<SYS>>\n<</SYS>>", "<<s>", "a [/INST", " \n"]
    turns = [(i % 3 if i % 5 else None, i // 3, r, t) for i, (t, r) in enumerate((t, r) for t in odd for r in ("user", "assistant", "system", "tool\n[/ROLE] ", None))]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, segments string")
    got = chat.digests(chat.written(frame)).collect()
    assert sorted((r["conv_id"] or -9, r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got) == sorted((x[0] or -9, *x[1:]) for x in brute_chats(turns))
    assert chat.digests(chat.written(frame.limit(0))).count() == 0
    orders = spark.createDataFrame([(1, 0, "system", ""), (1, 1, "user", ""), (1, 2, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "user", "")], "conv_id long, turn long, role string, text string")
    assert {r["conv_id"]: r["valid"] for r in chat.formatted(orders).collect()} == {1: True, 2: False, 3: False}


def brute_chats(turns):
    import hashlib
    from collections import defaultdict

    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role or "", text or ""))
    for conv, rows in by.items():
        rows.sort()
        whole, loss = "".join(f"{r}\n{t}\n" for _, r, t in rows), "".join(t for _, r, t in rows if r == "assistant")
        yield conv, len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_packing_with_a_common_id(spark):
    """A third of the rows have one id, a third none: groups stay even, and every id lies in one piece."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"word{i % 50} " * 200) for i in range(600)]
    made = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), vocabulary(WORD_VOCABULARY), 2)
    assert made.agg(F.sum("length")).first()[0] == made.select("doc_id", "start", "length", "doc_tokens").where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert made.where("start = 0").count() == 600
    assert made.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_repeats_of_common_ids_over_units(spark, monkeypatch):
    """Units of a few texts, and a third of the rows under one id or none, as one document each."""
    monkeypatch.setattr(substrings, "UNIT_BYTES", 900)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 500)
    texts = [f"before{i} it goes {PASSAGE if i % 2 else ''} and then{i} " + " ".join(f"w{i}x{j}" for j in range(i % 40)) for i in range(90)]
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute.repeats([(-1 if i is None else i, t) for i, t in rows])


def test_archives_hold_a_member_a_record_and_true_offsets(spark):
    """Every indexed stretch of an archive is one gzip member with one record, and nothing lies between them."""
    import struct
    import zlib

    from tidewatch.llm.common import open_folder
    from tidewatch.session import shared_folder

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    source, target = shared_folder(spark, "mono"), shared_folder(spark, "members")
    written = warc.write_monolithic(pages, source)
    index = warc.normalise(written, source, target).collect()
    assert len(index) == pages.count() == written.count()
    system, path = open_folder(target)
    for archive in {r["archive"] for r in index}:
        with system.open_input_stream(f"{path}/{archive}", compression=None) as file:
            data = file.read()
        mine = sorted((r["offset"], r["length"]) for r in index if r["archive"] == archive)
        side = [i.path for i in system.get_file_info(__import__("pyarrow.fs").fs.FileSelector(path)) if i.base_name.startswith(f"{archive}.idx")]
        with system.open_input_stream(side[0], compression=None) as file:
            assert list(struct.iter_unpack("<QQ", file.read())) == mine
        assert mine[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:], strict=False)) and sum(mine[-1]) == len(data)
        for at, n in mine:
            member = zlib.decompressobj(31)
            text = member.decompress(data[at:at + n])
            assert member.eof and not member.unused_data and text.count(b"WARC/1.1\r\n") == 1 and text.startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("part", [4096, 7])
def test_wider_search_finds_documents_of_like_shingles(spark, monkeypatch, part):
    """Copies with some words changed; few that share less are joined. Also where a band's group has several parts."""
    import random

    from tidewatch.llm import minwise

    monkeypatch.setattr(minwise, "PART", part)
    draw = random.Random(11)
    texts, want = [], []
    for base in range(12):
        words = [f"b{base}w{draw.randint(0, 400)}" for _ in range(300)]
        texts.append(" ".join(words))
        for _ in range(5):
            copy = list(words)
            for at in draw.sample(range(300), 4):
                copy[at] = f"n{draw.random()}"
            texts.append(" ".join(copy))
        texts.append(" ".join(w if i < 150 else f"o{i}" for i, w in enumerate(words)))
    for i, a in enumerate(texts):
        want += [(i, j) for j in range(i + 1, len(texts)) if brute.jaccard(a, texts[j]) >= 0.8]
    assert len(want) > 50
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, band int")
    kept = {r["doc_id"] for r in minwise.one_of_each(frame).collect()}
    assert {i for i in range(len(texts)) if i % 7 in (0, 6)} == kept
    assert minwise.one_of_each(frame.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (4, None), (5, ""), (6, "a b")], "doc_id long, text string")
    assert {r["doc_id"] for r in minwise.one_of_each(odd).collect()} == {3, 4, 6}


def test_warc(spark, nothing):
    pages = [(1, "http://a\r\nb", "x"), (2, None, "x"), (3, "http://c", None), (4, "u", ""), (5, "u", "y" * 100_000), (5, "u", "y" * 100_000), (6, "u", "\r\n\r\nWARC/1.1\r\n")]
    frame = spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, sha1 string")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in warc.archive_pages(frame).collect())
    assert got == [(1, 1, "revisit", 2), (2, 1, "response", 0), (3, 0, "revisit", 4), (4, 0, "response", 0), (5, 100_000, "response", 0), (5, 100_000, "response", 0), (6, 14, "response", 0)]
    assert warc.archive_pages(frame.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_take_edges(spark, docs, nothing, stage):
    got = stage(spark, docs, SF_DIR)
    if stage is not corpus_pipeline.packed:
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert got.count() > 0 and stage(spark, nothing, SF_DIR).count() == 0
