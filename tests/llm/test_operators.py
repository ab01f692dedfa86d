"""Each operator against a brute-force version on small tables."""

import collections
import functools
import hashlib
import json
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from editflow.llm import decontam, deobfuscate, embeddings, licences, minhash, mixing, perplexity, suffix, toolcalls, toxicity, warc
from editflow.llm.graph import components
from editflow.llm.words import shingle_hashes, shingle_set, word_hashes

DOCS = "doc_id long, text string"


def words(rng, n, names=400):
    return [f"w{rng.randrange(names)}x" for _ in range(n)]


def near_texts(seed=1):
    """Texts with exact copies, chains of near copies, a common line, short and empty ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = words(rng, 120)
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            base = list(base)
            base[rng.randrange(120)] = "new"
            texts.append(" ".join(base))
    line = " ".join(words(rng, 12))
    texts += [line + "\n" + " ".join(words(rng, 50)) for _ in range(25)]
    texts += ["one two", "ONE  two", "", " \t\n", "a b c d e", "A b c d\ve", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return texts


def reached(ids, links):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_words_are_runs_of_other_bytes_than_blanks():
    texts = [b"", b"A bc\x0bd  E", b"\xc3\x84b c", b"  x", b"a" * 5000 + b" " + b"a" * 4999]
    data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, counts = word_hashes(data, starts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(hashes.tolist())) == len({w for t in texts for w in t.lower().split()})
    shingles, many = shingle_hashes(hashes, counts, 3)
    assert many.tolist() == [0, 2, 1, 1, 1] and len(shingles) == 5


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    frame = spark.createDataFrame([(b, a) for a, b in links] + [(7, None)], "a long, b long")
    want = reached(range(300), links)
    got = {r.node: r.component for r in components(frame, "a", "b").collect()}
    assert got == {n: want[n] for pair in links for n in pair if pair[0] != pair[1]}


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_near_copies_equal_all_pairs(spark, monkeypatch, block):
    """With blocks of three, nearly all postings are split by a second coordinate."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = dict(enumerate(near_texts()))
    sets = {i: shingle_set(t.encode()) for i, t in texts.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = reached(sets, links)
    found = minhash.near_copies(spark.createDataFrame(list(texts.items()), DOCS)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert got == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}
    assert len(links) > 10 and links != [(a, b) for a, b in links if sets[a] == sets[b]]


def test_a_wide_posting_is_split_so_that_only_likely_pairs_meet(spark, monkeypatch):
    """200 texts share a passage and so many coordinates, but only ten pairs of them are near copies."""
    rng = random.Random(5)
    passage = words(rng, 60, 5_000)
    texts = {}
    for i in range(200):
        own = words(rng, 60, 50_000)
        texts[i] = " ".join(own + passage)
        if i % 20 == 0:
            own[30] = "other"
            texts[1_000 + i] = " ".join(own + passage)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    signed = minhash.signatures(docs).collect()
    nodes = spark.createDataFrame([(r.doc_id, r.signature) for r in signed], "doc_id long, signature array<long>")
    posted = nodes.select("doc_id", F.posexplode("signature").alias("coord", "value"))
    parts = minhash._split(posted, nodes, 20).collect()
    met = collections.Counter((r.coord, r.value, r.coord2, r.value2) for r in parts)
    assert sum(n * n for n in met.values()) < 200 * 200
    found = {r.doc_id: r.component_id for r in minhash.near_copies(docs).collect()}
    assert {i for i, top in found.items() if i != top} == {1_000 + i for i in range(0, 200, 20)}


def test_matches_follow_the_threshold():
    assert minhash.least_matches(85) == 20 and minhash.least_matches(80) == 17
    for percent in (50, 70, 80, 85, 90, 99):
        matches = minhash.least_matches(percent)
        share = [math.comb(32, k) * (percent / 100) ** k * (1 - percent / 100) ** (32 - k) for k in range(32)]
        assert sum(share[:matches]) <= minhash.MISSED < sum(share[: matches + 1])
    assert minhash.least_matches(100) == 32


def repeats_by_hand(texts, length=100):
    seen, out = set(), {}
    for key in sorted(texts):
        text = (texts[key] or "").encode()
        covered = bytearray(len(text))
        for p in range(len(text) - length + 1):
            window = text[p : p + length]
            if window in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, c in zip(text, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[key] = (len(text), sum(covered), spans, kept)
    return out


def test_repeated_strings_equal_all_windows(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdé ") for _ in range(150))
    short = "".join(rng.choice("abcd ") for _ in range(90))
    texts = {}
    for i in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 400))) for _ in range(3)]
        texts[i] = parts[0] + (passage[rng.randrange(30) :] if i % 2 else "") + parts[1] + short + parts[2]
    texts |= {60: texts[3], 61: texts[3] + "x", 62: "z" * 700, 63: "z" * 350, 64: "", 65: None, 66: "ab" * 99}
    found = suffix.without_repeats(spark.createDataFrame(list(texts.items()), DOCS)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found}
    assert got == repeats_by_hand(texts)


def test_suffixes_are_equal_only_in_all_bytes():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2500] = data[200:1200]
    data[700] = 1
    at = np.arange(0, 2900)
    got = suffix.repeated_suffixes(data, at, np.zeros(len(at), np.int64), 100)
    seen, want = set(), []
    for p in at.tolist():
        window = data[p : p + 100].tobytes()
        want += [p] if window in seen else []
        seen.add(window)
    assert got.tolist() == want and len(want) > 500


def test_benchmark_items_equal_all_pairs(spark):
    rng = random.Random(5)
    items = {i: " ".join(words(rng, rng.choice([6, 20, 64, 150]))) + ". The end is here" for i in range(40)}
    docs = {}
    for i in range(120):
        parts = [" ".join(words(rng, rng.randrange(5, 200)))]
        if i % 4 == 0:
            parts.append(items[rng.randrange(40)].upper())
        if i % 7 == 0:
            parts.append(" ".join(items[rng.randrange(40)].split()[:5]))
        docs[i] = " ".join([*parts, " ".join(words(rng, 30))])
    found = decontam.contaminated(
        spark.createDataFrame(list(docs.items()), DOCS), spark.createDataFrame(list(items.items()), "item_id long, text string")
    ).collect()
    shingles = {i: shingle_set(t.encode()) for i, t in items.items()}
    want = {
        (d, i) for d, t in docs.items() for i, s in shingles.items()
        if len(s & shingle_set(t.encode())) >= 0.8 * len(s)
    }
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) >= 30


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 32))
    vectors = np.concatenate([centres[rng.integers(0, 30, 300)] + rng.normal(size=(300, 32)) * s for s in (0.1, 0.35)])
    vectors = np.concatenate([vectors, vectors[:20], vectors[:5] * 3]).astype(np.float32)
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    near = units @ units.T >= embeddings.THRESHOLD
    np.fill_diagonal(near, False)
    want = reached(range(len(units)), list(zip(*map(np.ndarray.tolist, np.nonzero(near)))))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = embeddings.near_vectors(frame).collect()
    links = {r.vec_id: r.n_links for r in found}
    assert sum(links.values()) >= 0.97 * near.sum() > 1000
    assert all(links[i] <= n for i, n in enumerate(near.sum(1)))
    assert np.mean([r.component_id == want[r.vec_id] for r in found]) > 0.97


def test_estimates_are_unbiased_and_inside_their_bounds():
    rng = np.random.default_rng(7)
    turn = embeddings.rotation(64, 1)
    offsets, queries = rng.normal(size=(400, 64)), rng.normal(size=(50, 64))
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    codes, reach, factor = embeddings.encode(offsets, turn)
    guess, bound = embeddings.estimate(codes, factor, queries @ turn)
    gap = guess - (offsets / reach[:, None]) @ queries.T
    assert abs(gap.mean()) < 0.002 and (np.abs(gap) <= bound).mean() > 0.999


def test_archives_round_trip(spark):
    rng = random.Random(8)
    long = "<html>" + "ä same " * 40
    pages = [(i, f"http://e.example/{i}", "<p>" + " ".join(words(rng, 80))) for i in range(30)]
    pages += [(40, "u", long), (41, None, long), (39, " a\r\nb ", long), (42, "", ""), (43, "x", None), (44, "x", "short"), (45, "x", "short")]
    found = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    rows = {r.page_id: r for r in found}
    assert len(found) == len(pages) == len(rows)
    for page, _, html in pages:
        payload, row = (html or "").encode(), rows[page]
        assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        later = page in (40, 41)
        assert (row.record_type, row.refers_to) == (("revisit", 39) if later else ("response", None))
        assert later or bytes(row.payload) == payload


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others_are_read_and_bad_ones_refused(packed):
    record = warc.record(1, "u", b"x" * 300, hashlib.sha256(b"x" * 300).hexdigest(), "response", None)
    trained = zstandard.train_dictionary(4096, [record + bytes([i]) * 20 for i in range(200)]).as_bytes()
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    first = zstandard.ZstdCompressor().compress(trained) if packed else trained
    data = warc.archive_start(first) + press.compress(record) + b"\x50\x2a\x4d\x18\x02\0\0\0ab" + press.compress(record)
    found, frames = warc.frames_of(data)
    spans = list(frames)
    assert found == trained and len(spans) == 2
    open_ = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(found))
    assert [open_.decompress(data[a:b]) for a, b in spans] == [record, record]
    assert warc.read_record(record)[2:5] == (300, hashlib.sha256(b"x" * 300).hexdigest(), "response")
    for cut in (data[:-3], data + b"junk", data[8:]):
        with pytest.raises(warc.BadRecord):
            list(warc.frames_of(cut)[1])
    for bad in (record[:-1], record.replace(b"Length: 3", b"Length: 2", 1), record.replace(b"x", b"y", 1), record.replace(b"WARC/1.1", b"WARC/9", 1), record.replace(b"WARC-Date", b"WARC-Day", 1)):
        with pytest.raises(warc.BadRecord):
            warc.read_record(bad)


def test_calls_are_linked_ordered_and_checked(spark):
    def call(i, after=(), arguments='{"words": 2, "role":"user","chars":3}', name="reply"):
        return {"id": i, "name": name, "arguments": arguments, "after": list(after)}

    rows = [
        (1, 0, "assistant", json.dumps({"tool_calls": [call("a"), call("b", ["a", "nobody"]), call("c", ["b", "a"])]})),
        (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "first"})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "second"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "z", "content": "no call"})),
        (2, 0, "assistant", json.dumps({"tool_calls": [call("a", ["b"]), call("b", ["a"]), call("d", ["b"])]})),
        (2, 1, "assistant", json.dumps({"tool_calls": [call("e", arguments="{bad"), call("e"), call("f", name="?")]})),
        (2, 2, "assistant", json.dumps({"tool_calls": [call("g", arguments='{"chars":"3","words":2,"role":"user"}')]})),
        (2, 3, "assistant", "plain text"), (None, 1, "assistant", "x"), (3, 1, None, None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.call_id): r for r in toolcalls.linked_calls(frame).collect()}
    assert {k: r.level for k, r in got.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "a"): None, (2, "b"): None, (2, "d"): None, (2, "e"): 0, (2, "f"): 0, (2, "g"): 0
    }
    assert (got[1, "a"].result, got[1, "a"].result_turn, got[1, "b"].result) == ("first", 1, None)
    assert got[1, "a"].arguments == '{"chars":3,"role":"user","words":2}'
    assert {k for k, r in got.items() if not r.valid} == {(2, "f"), (2, "g"), (2, "e")} - (
        {(2, "e")} if got[2, "e"].arguments else set()
    )


def levels_by_hand(calls):
    """Rounds over one conversation: call -> the calls it names."""
    level = {}
    while True:
        free = [c for c in calls if c not in level and all(a in level for a in calls[c] if a in calls)]
        if not free:
            return level
        level |= {c: max([level[a] + 1 for a in calls[c] if a in calls], default=0) for c in free}


def test_levels_of_long_chains_meetings_and_cycles(spark):
    rng = random.Random(5)
    conversations = {"chain": {str(t): [str(t - 1)] * (t > 0) for t in range(90)}}
    for conv in ("mixed", "cycle"):
        names = conversations[conv] = {}
        for t in range(60):
            several = rng.choice([0, 1, 1, 1, 1, 1, 2, 3]) * (t > 0)
            names[str(t)] = [str(rng.randrange(max(0, t - 4), t)) for _ in range(several)]
    conversations["cycle"]["20"] = ["26", "unknown"]
    conversations["cycle"]["40"] = ["40"]
    conversations["all"] = {"a": ["b"], "b": ["a"]}
    rows = [(v, int(c) if c.isdigit() else 0, c, a) for v, calls in conversations.items() for c, a in calls.items()]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, call_id string, after array<string>")
    got = {(r.conv_id, r.call_id): r.level for r in toolcalls.levels(frame).collect()}
    want = {(v, c): n for v, calls in conversations.items() for c, n in levels_by_hand(calls).items()}
    assert got == want and max(want.values()) == 89 and len(want) < len(rows)


def test_mix_meets_its_targets_and_runs_agree(spark):
    rng = random.Random(9)
    rows = [(i, f"s{i % 4}" if i % 9 else None, " ".join(words(rng, int(rng.paretovariate(1.2) * 5) % 900))) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    first = {r.doc_id: r for r in mixing.mixed(frame).collect()}
    again = {r.doc_id: r.copies for r in mixing.mixed(frame.repartition(7)).collect()}
    assert {i: r.copies for i, r in first.items()} == again and len(first) == 900
    sizes = collections.Counter()
    for i, source, text in rows:
        assert first[i].size == len(text.split()) and 0 <= first[i].taken <= 2 * first[i].size
        sizes[source] += len(text.split())
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    goal, open_ = dict.fromkeys(order, 0.0), set(order)
    rest = 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > 2 * sizes[s]}
        if not over:
            break
        open_ -= over
        rest -= sum(2 * sizes[s] for s in over)
        goal |= {s: 2.0 * sizes[s] for s in over}
    goal |= {s: rest * weight[s] / total for s in open_}
    for s in order:
        mine = [first[i] for i, source, _ in rows if source == s]
        assert mine[0].target == pytest.approx(goal[s]) and mine[0].source_size == sizes[s]
        assert sum(r.taken for r in mine) == pytest.approx(goal[s], rel=0.02)


def test_licence_rules_want_their_sentences_in_order(spark):
    mit = licences.SENTENCES[2], licences.SENTENCES[3]
    texts = [
        "Prose.\nReleased under the MIT License.\nMore.", f"{mit[0]}.\nOne. Two.\n{mit[1]}.", f"{mit[1]}.\n{mit[0]}.",
        f"{mit[0]}.\nOne. Two. Three.\n{mit[1]}.", "Licensed under the Apache License, Version 2.0.\nLICENSED UNDER CC BY-NC 4.0!", "", None,
    ]
    found = licences.licences(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    got = {r.doc_id: (r.licences, r.n_known) for r in found}
    assert got == {0: ("MIT", 1), 1: ("MIT", 2), 2: ("", 2), 3: ("", 2), 4: ("Apache-2.0,CC-BY-NC-4.0", 2), 5: ("", 0), 6: ("", 0)}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_published_licences_wrapped_and_numbered(spark):
    def unwrapped(text):
        return "\n\n".join(" ".join(part.split()) for part in text.split("\n\n"))

    commented = "".join(f" * {line}\n" for line in GPL.splitlines())
    bullets = BSD.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    texts = [
        MIT, GPL, BSD, unwrapped(MIT), unwrapped(GPL), unwrapped(BSD), commented, bullets, MIT.replace("\n", "\r\n"),
        BSD.replace("1. ", "1) ").replace("2. ", "2) ").replace("3. ", "(3) "), BSD[: BSD.index("3. ")],
        "A title\nReleased under the MIT License\nand more", MIT.replace("The above", "One. Two. Three. The above"),
    ]
    found = licences.licences(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    got = {r.doc_id: r.licences for r in found}
    bsd = "BSD-3-Clause,BSD-2-Clause"
    want = ["MIT", "GPL-3.0", bsd, "MIT", "GPL-3.0", bsd, "GPL-3.0", bsd, "MIT", bsd, "BSD-2-Clause", "MIT", ""]
    assert got == dict(enumerate(want))
    assert all(re.search(licences.HINT, s) for s in licences.SENTENCES)


NOTICES = {
    "Released under the MIT license, see file.": "MIT",
    "This file is released under the MIT License.": "MIT",
    "The software is distributed under the terms of the GNU General Public License, version 2. Thanks!": "GPL-2.0",
    "3. All files are available under the ISC Licence; see the LICENSE file for details.": "ISC",
    "Available under CC BY-SA 4.0": "CC-BY-SA-4.0",
    "the MIT license is short": "",
    "We released the book under pressure.": "",
}
ISC = """Copyright someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
LGPL = """  This library is free software; you can redistribute it and/or
  modify it under the terms of the GNU Lesser General Public
  License as published by the Free Software Foundation; either
  version 2.1 of the License, or (at your option) any later version.
"""


def test_notices_lead_ins_and_headings(spark):
    texts = [*NOTICES, ISC, LGPL, "MIT License\n" + MIT, "1.\n2.\n" + BSD]
    want = [*NOTICES.values(), "ISC", "LGPL-2.1", "MIT", "BSD-3-Clause,BSD-2-Clause"]
    found = licences.licences(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    got = {r.doc_id: r.licences for r in found}
    assert [got[i] for i in range(len(texts))] == want


def test_licences_against_sql(spark, tmp_path):
    """Wrapped and numbered texts, headings, null and empty ones, mixed by chance."""
    from checks import compare
    from editflow.llm import queries

    rng = random.Random(4)
    blocks = [MIT, GPL, BSD, ISC, LGPL, *NOTICES, "Some prose. More of it\nover two lines.", "1.\n2.\n", "\n\n", "12", ""]
    texts = ["\n".join(rng.choice(blocks) for _ in range(rng.randrange(1, 7))) for _ in range(120)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    connection = compare.duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = connection.execute(queries.oracle_sql()["op6_licences"])
    want = compare.rows_of([c[0] for c in result.description], result.fetchall())
    got = queries.op6_licences(spark, str(tmp_path))
    assert compare.rows_of(got.columns, got.collect()) == want
    assert len({r[1] for r in want[1]}) > 5


def plain_model(texts, order=perplexity.ORDER):
    """Chance of a letter after others under interpolated modified Kneser-Ney, straight from its definition."""
    seen = {order: collections.Counter()}
    for text in texts:
        padded = " " * (order - 1) + text + " "
        seen[order].update(padded[i : i + order] for i in range(len(text) + 1))
    for n in range(order - 1, 0, -1):
        seen[n] = collections.Counter(gram[1:] for gram in seen[n + 1])

    def lowered(n, count):
        k = min(count, 3)
        have = collections.Counter(seen[n].values())
        if not have[k] or not have[1] + have[2]:
            return min(0.5 * k, count)
        y = have[1] / (have[1] + 2 * have[2])
        return min(max(0.0, min(k, k - (k + 1) * y * have[k + 1] / have[k])), count)

    @functools.cache
    def chance(letter, before):
        if before is None:
            return 1 / (len(seen[1]) + 1)
        n = len(before) + 1
        shorter = chance(letter, before[1:] if before else None)
        follow = {g[-1]: c for g, c in seen[n].items() if g[:-1] == before}
        if not follow:
            return shorter
        total, left = sum(follow.values()), sum(lowered(n, c) for c in follow.values())
        count = follow.get(letter, 0)
        return ((count - lowered(n, count) if count else 0) + left * shorter) / total

    return chance, list(seen[1])


def test_language_model_equals_its_definition_and_finds_junk(spark):
    order = perplexity.ORDER
    rng = random.Random(10)
    good = [(i, "en", " ".join(rng.choice(["the", "cat", "sat", "on", "mat", "\U0001f600"]) for _ in range(40))) for i in range(60)]
    junk = [(100 + i, "en", "".join(rng.choice("#%@!zxq ") for _ in range(120))) for i in range(10)]
    others = [(200, "xx", "abc"), (201, "en", ""), (202, None, None), (203, "en", "a"), (204, "en", "Zoë sat")]
    docs = spark.createDataFrame(good + junk + others, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(i, 0) for i in range(100, 105)], "doc_id long, quality int")
    found = {r.doc_id: r for r in perplexity.quality(docs, labels).collect()}
    kept = {i: r.kept for i, r in found.items()}
    assert not any(kept[i] for i in range(100, 110)) and sum(kept[i] for i in range(60)) >= 55
    assert (kept[200], kept[201], kept[202]) == (True, False, False)

    # Letters are UTF-16 units: a sign beyond 16 bits counts as two.
    def units(text):
        data = text.encode("utf-16-le")
        return "".join(chr(int.from_bytes(data[i : i + 2], "little")) for i in range(0, len(data), 2))

    chance, letters = plain_model([units(t) for i, _, t in good if i < 40])
    for before in ("", "t", " ca", "the", "xyz"):
        assert sum(chance(x, before) for x in [*letters, "never"]) == pytest.approx(1)
    for i, lang, text in good + junk + others:
        if lang == "en" and text:
            padded = " " * (order - 1) + units(text) + " "
            costs = [-math.log(chance(padded[j], padded[j - order + 1 : j])) for j in range(order - 1, len(padded))]
            assert found[i].log_perplexity == pytest.approx(sum(costs) / len(costs), rel=1e-5), i
        else:
            assert found[i].log_perplexity is None


def test_language_model_in_blocks_of_any_size(spark):
    docs = spark.createDataFrame([(i, "en", "abc " * (i % 7)) for i in range(90)], "doc_id long, lang string, text string")
    long = spark.createDataFrame([(90, "en", "abc " * 300_000), (91, "en", "abc " * 30_000)], docs.schema)
    docs = docs.union(long)
    model = perplexity.model_of(perplexity.gram_counts(docs.where("doc_id < 20").select("lang", "text")))
    whole = {r.doc_id: r.log_perplexity for r in perplexity.perplexities(docs.coalesce(1), model).collect()}
    split = {r.doc_id: r.log_perplexity for r in perplexity.perplexities(docs.repartition(13, "doc_id"), model).collect()}
    assert len(whole) == len(split) == 92 and whole[90] == pytest.approx(whole[91], rel=1e-3)
    assert all(whole[i] == pytest.approx(split[i]) if whole[i] is not None else split[i] is None for i in whole)


def toxic_table(spark, n=400):
    rng = random.Random(11)
    plain = ["the", "house", "garden", "of", "letters", "and", "some", "trees", "stand", "lost", "table", "river"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(plain) for _ in range(30)]
        if i % 5 == 0:
            text[rng.randrange(30)] = rng.choice(["villain", "rascal"])
            text[rng.randrange(30)] = rng.choice(["villain", "rascal"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def words_meant(text, letters):
    signs = deobfuscate.Signs.of([text])
    words, strings = deobfuscate.parts(signs.texts[0], bool(signs.spaced()), bool(signs.tripled()))
    return words | {w for s in strings for w in deobfuscate.both(deobfuscate.decode(s, letters))}


def letters_of(texts):
    """The model of some texts, counted letter by letter."""
    counts, total, seen = collections.Counter(), 0, set()
    for text in texts:
        codes = [0, 0, *(ord(x) if re.match(r"[^\W\d_]", x) else 0 for x in text.lower()), 0, 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            if b or c:
                counts.update(deobfuscate.Letters.keys(a, b, c))
                total += 1
                seen.add(c)
    return deobfuscate.Letters(dict(counts), total, len(seen) + 1)


def test_toxic_words_are_found_under_disguise(spark):
    docs, labels = toxic_table(spark)
    disguises = ["v1ll@in", "v i l l a i n", "viiiillain", "r4$cal###", "r.a.s.c.a.l", "Rascal!!", "plain trees"]
    more = [(5 * (1_000 + i), f"the house of {d} and some trees {d}") for i, d in enumerate(disguises)]
    docs = docs.unionByName(spark.createDataFrame(more, DOCS)).withColumn("score", F.lit("mine"))
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert [found[i].predicted for i, _ in more] == [1] * 6 + [0]
    wrong = [r for i, r in found.items() if i < 400 and r.held_out and r.predicted != (i % 5 == 0)]
    assert len(found) == 407 and len(wrong) <= 2 and 0 < sum(r.held_out for r in found.values()) < 200


def test_combined_disguises_and_words_across_any_edge():
    rng = random.Random(9)
    names = "the quick rascal villain house garden paper letter number window reading writing people water".split()
    model = letters_of([" ".join(rng.choice(names) for _ in range(50)) for _ in range(200)])
    for disguise in ["r @ s c a l", "r @ $ c a l", "r\n@\t$\nc,a\tl", "(r . 4 . s . c . 4 . l).", "r _ @ * s - c a l !", "v 1 l l a 1 n"]:
        found = words_meant(f"people and {disguise} house", model)
        assert found & {"rascal", "villain"}, disguise
    assert "pap" in words_meant("p a p", model)
    for lead in range(1, 90):
        # A word that starts at any place of a long token, after letters that are one word.
        token = "water." * (lead // 6) + "p" * (lead % 6) + ".r@sc4l." + "window." * 40 + "v1llain"
        assert {"rascal", "villain"} <= words_meant(token, model), lead
    long = deobfuscate.decode("w1ndow." * 500, model).split()
    assert long == ["window"] * 500


def test_letters_of_any_script():
    rng = random.Random(3)
    model = letters_of([" ".join(rng.choice("мерзавец дом зелёный сад окно человек большой".split()) for _ in range(40)) for _ in range(50)])
    assert "мерзавец" in words_meant("ммммерзавец", model)
    assert "мерзавец" in words_meant("м е р з а в е ц", model)
    assert deobfuscate.decode("мер*завец", model) == "мерзавец"


def all_readings(observed, letters):
    """Every way to read a short string, with its cost."""
    best = {}

    def go(at, a, b, last, price, text):
        if at == len(observed):
            price += letters(a, b, 0) if b else 0.0
            text = text.strip()
            best[text] = min(price, best.get(text, math.inf))
            return
        for (x, y, new), channel, read, scored in deobfuscate._steps((a, b, last), observed[at], deobfuscate._options(observed[at])):
            go(at + 1, x, y, new, price + channel + (letters(a, b, scored) if scored >= 0 else 0.0), text + read)

    go(0, 0, 0, "", 0.0, "")
    return best


def test_decoding_against_all_readings():
    rng = random.Random(6)
    model = letters_of(["all the small boats sail slowly past the old castle", "good tea is best"])
    for _ in range(150):
        observed = "".join(rng.choice("aalst1!0@$5|. *é") for _ in range(rng.randrange(1, 8)))
        readings = all_readings(observed, model)
        found = deobfuscate.decode(observed, model)
        assert readings[found] == pytest.approx(min(readings.values())), observed
        # The trigrams that a block asks for are all that a decoding needs.
        asked = {key for gram in deobfuscate.passed(observed) for key in deobfuscate.Letters.keys(*gram)}
        part = deobfuscate.Letters({k: v for k, v in model.counts.items() if k in asked}, model.total, model.alphabet)
        assert deobfuscate.decode(observed, part) == found


def test_the_cheap_look_finds_what_the_pattern_finds():
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab 1@$.,-é_\n€ ") for _ in range(rng.randrange(30))) for _ in range(3_000)]
    signs = deobfuscate.Signs.of(texts)
    assert signs.spaced() == {i for i, t in enumerate(texts) if deobfuscate._SPACED.search(t.lower())}
    assert signs.tripled() == {i for i, t in enumerate(texts) if deobfuscate._TRIPLE.search(t.lower())}


def test_letters_and_readings_of_a_corpus(spark, monkeypatch):
    """Counted over many texts and in blocks, as letter by letter at once."""
    rng = random.Random(8)
    names = "the quick rascal villain house мерзавец größe 漢字 paper".split()
    disguises = ["v1ll@in", "r 4 s c a l", "мммерзавец", "gr0ße", "ho-use", "漢 字 漢 字"]
    texts = [" ".join(rng.choice(names) for _ in range(30)) + " " + rng.choice(disguises) for _ in range(200)] + [None, "", "\n"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    monkeypatch.setattr(deobfuscate, "BLOCK", 2)
    trigrams, strings = deobfuscate.survey(docs)
    model = letters_of([t or "" for t in texts])
    got = {(deobfuscate.TRI, r.gram): r["count"] for r in trigrams.collect()}
    assert got == {k: v for k, v in model.counts.items() if k[0] == deobfuscate.TRI}
    grams = {(r.kind, r.key): r["count"] for r in deobfuscate.gram_table(trigrams).collect()}
    assert grams == model.counts
    read = {r.string: r.reading for r in deobfuscate.readings(strings, trigrams).collect()}
    assert read == {s: deobfuscate.decode(s, model) for s in read} and len(read) >= 6
    assert read["v1ll@in"] == "villain"


def test_samples_reach_the_driver_within_bounds(spark):
    """500 partitions and a limit of 16 MB for what tasks send: dictionaries and centres still come."""
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    letters = F.concat_ws(" ", F.sequence(F.col("id"), F.col("id") + 400))
    rows = spark.range(0, 6_000, 1, 500).select(
        F.col("id").alias("page_id"), F.col("id").cast("string").alias("url"), letters.alias("html")
    )
    texts = rows.select(F.col("page_id").alias("doc"), F.encode("html", "UTF-8").alias("text"))
    vectors = spark.range(0, 20_000, 1, 500).select(
        F.col("id").alias("vec_id"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(F.col("id") * i)).alias("embedding"),
    )
    units = vectors.mapInArrow(embeddings._scale, embeddings._UNIT).where("key is not null")
    conf.set("spark.driver.maxResultSize", "16m")
    try:
        assert len(warc.dictionary(rows)) > 0 and len(suffix.dictionary(texts)) > 0
        assert embeddings._centres(units, embeddings.SAMPLE, 1).shape[1] == 64
    finally:
        conf.set("spark.driver.maxResultSize", before)


def test_a_sample_is_the_same_in_every_run(spark):
    from editflow.llm.tables import sampled

    rows = spark.range(5_000).withColumn("copy", F.lit(1))
    first = {r.id for r in sampled(rows, ["id"], 100, "s")}
    assert len(first) == 100 and first == {r.id for r in sampled(rows.repartition(13), ["id"], 100, "s")}
    assert len(sampled(rows.limit(7), ["id"], 100, "s")) == 7
    assert len(sampled(rows, ["copy"], 100, "s")) == 1


def test_scores_do_not_depend_on_the_number_of_indexes(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.randrange(8, 150), 300)) + ". " + " ".join(words(rng, 9, 300))) for i in range(60)]
    texts = [(i, " ".join(words(rng, 60)) + " " + rng.choice(items)[1] + " " + " ".join(words(rng, 30))) for i in range(80)]
    docs = spark.createDataFrame(texts, DOCS)
    table = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontam.contaminated(docs, table).collect()))
    many = sorted(map(tuple, decontam.contaminated(docs, table, index_bytes=3_000).collect()))
    assert len(one) >= 80 and one == many


def test_a_question_with_another_answer_is_no_contamination(spark):
    question = "what is the name of the long river that runs through the green valley of the north"
    items = spark.createDataFrame([(1, question + "? it is called the silver water by all who live there")], "item_id long, text string")
    rows = [
        (1, "so " + question + "? it is called the silver water by all who live there indeed"),
        (2, "so " + question + "? nobody has ever told me anything about that at all indeed"),
        (3, "so people say it is called the silver water by all who live there indeed"),
    ]
    found = decontam.contaminated(spark.createDataFrame(rows, DOCS), items, overlap=0.4).collect()
    assert [(r.doc_id, r.question, r.answer) for r in found] == [(1, 1.0, 1.0)]


def test_an_ask_any_number_of_turns_back(spark):
    roles = ["assistant", "user"] + ["assistant"] * 4 + ["user", "assistant", "user"] + ["assistant"] * 60 + ["system"]
    turns = [("c", i, role, f"text {i}", "mine") for i, role in enumerate(roles)]
    turns += [("d", 5, "assistant", "early", "x"), ("d", None, "user", "lost", "x"), (None, 1, "user", "lost", "x")]
    turns += [("c", 2, "assistant", "a smaller text", "tie")]
    frame = spark.createDataFrame(turns, "conv_id string, turn int, role string, text string, call_id string")
    rows = toolcalls.linked_calls(toolcalls.as_messages(frame)).collect()
    got = {r.turn: (r.level, r.result_turn, r.result) for r in rows}
    assert got == {1: (0, 2, "a smaller text"), 6: (1, 7, "text 7"), 8: (2, 9, "text 9"), 69: (3, None, None)}


def test_cut_letters_go_and_replacement_signs_stay(spark):
    """A repeated string of 100 bytes ends inside a letter of two bytes; U+FFFD elsewhere is text."""
    line = "x" * 99
    rows = [(1, line + "é first"), (2, "keep � sign " + line + "è second �")]
    found = suffix.without_repeats(spark.createDataFrame(rows, DOCS), letters=True).collect()
    kept = {r.doc_id: (bytes(r.kept).decode(), r.n_removed) for r in found}
    assert kept == {1: (rows[0][1], 0), 2: ("keep � sign  second �", 100)}


def test_pipeline_stages_one_by_one(spark, tmp_path):
    import corpus_pipeline as pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(2)
    base = " ".join(words(rng, 60))
    line = " ".join(words(rng, 30, 9_999))
    rows = [
        (1, base, "en", "s", 1), (2, base + " end", "en", "s", 1), (2, " ".join(words(rng, 40)), "en", "s", 1),
        (3, "one � " + line, "en", "t", 1), (4, "two � " + line, "en", None, 1), (None, base, "en", "s", 1),
        (5, None, None, None, None), (6, "", "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, schema).withColumn("kept", F.lit(1))
    spark.createDataFrame([(1, " ".join(words(rng, 20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    copies = pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert copies.columns == list(pipeline.COLUMNS)
    first = min([rows[1], rows[2]], key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())
    assert {r.doc_id for r in copies.collect()} == {1, 3, 5, 6, None} | ({2} if first is rows[2] else set())
    again = pipeline.drop_near_copies(spark, docs.repartition(5), str(tmp_path))
    assert sorted(map(str, copies.collect())) == sorted(map(str, again.collect()))
    cut = pipeline.cut_repeats(spark, docs.where("doc_id in (3, 4)"), str(tmp_path)).collect()
    texts = {r.doc_id: (r.text, r.n_chars) for r in cut}
    assert texts[3] == (rows[3][1], 1)
    assert texts[4][0].startswith("two") and "�" in rows[4][1] and texts[4][1] == len(texts[4][0]) < 12
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_quality_thresholds_by_hand(spark):
    """Per language, the least step of 1/500 that holds the quantile of the trusted texts; other texts are compared with it."""
    rng = random.Random(12)
    rows = [(i, " ".join(words(rng, rng.randrange(5, 40), 60)), rng.choice(["en", "de", None])) for i in range(150)]
    rows += [(200 + i, "zq" * (3 + i), "en") for i in range(10)] + [(300, "lonely text", "xx"), (301, None, "en"), (302, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 150, 2)] + [(201, 0), (301, 1), (999, 1)], "doc_id long, quality int")
    found = {r.doc_id: r for r in perplexity.quality(docs, labels, 0.9).collect()}
    assert len(found) == len(rows)
    for lang in ("en", "de", None):
        mine = [found[i] for i, _, name in rows if name == lang]
        steps = sorted(
            math.ceil(r.log_perplexity * perplexity.STEPS) for r in mine if r.doc_id < 150 and r.doc_id % 2 == 0
        )
        limit = next(s for k, s in enumerate(steps, 1) if k >= 0.9 * len(steps)) / perplexity.STEPS
        for r in mine:
            assert r.threshold == pytest.approx(limit)
            assert r.kept == (r.log_perplexity is not None and r.log_perplexity <= r.threshold)
    assert found[300].kept and found[300].threshold is None and not found[301].kept and not found[302].kept
    assert not any(found[200 + i].kept for i in range(10))
