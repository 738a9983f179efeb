"""URL filter, chat formatting, classifier, vectors, WARC and components over odd tables and against brute force."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellspark.llm import chat, quality, urls, vectors, warc
from cellspark.llm.components import connected_components
from tests.llm.builders import CLASHING, documents, odd_rows, prose
from tests.llm.test_documents import brute_hits, components

SF = "/root/testdata/sf0.001"


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (900, 900), (500, 501), (501, 500)]
    pairs += [(rng.randint(1000, 1040), rng.randint(1000, 1040)) for _ in range(25)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame([*pairs, (None, 3), (4, None)], "src bigint, dst bigint")).collect()}
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    linked = {frozenset(p) for p in pairs}
    root = components(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    assert got == {n: nodes[root[i]] for i, n in enumerate(nodes)}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


# --- urls --------------------------------------------------------------------------------------------------------


def pages(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def test_rules_hosts_and_paths(spark):
    rows = [
        (1, "HTTPS://Www.Example.ORG/es/1?q#f", None), (2, "http://a.org", ""), (3, "http://a.org/x", ""), (4, "no scheme", ""), (5, None, None),
        (6, "http://x.com/fr/?a=/de/", ""), (7, "http://x.com/de/", ""), (8, "http://example.org/en/12#t", ""), (9, "http://notexample.org/en/1", ""), (9, "http://notexample.org/en/1", ""),
        (10, "x://u?a://b/c", ""), (11, "http://ÉX.org/p", ""),
    ]
    got = sorted((tuple(r)[:5] for r in urls.judge(pages(spark, rows, clashing=True)).collect()), key=lambda r: (r[0], r[1]))
    assert got == [
        (1, "www.example.org", "/es/1", "example.org/es/", "block"), (2, "a.org", "", None, "allow"), (3, "a.org", "/x", "org/", "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "x.com", "/fr/", "com/fr/", "allow"), (7, "x.com", "/de/", "com/de/", "block"), (8, "example.org", "/en/12", "example.org/en/1", "block"),
        (9, "notexample.org", "/en/1", "org/", "allow"), (9, "notexample.org", "/en/1", "org/", "allow"), (10, "u", "", None, "allow"), (11, "Éx.org", "/p", "org/", "allow"),
    ]
    assert urls.judge(pages(spark, rows).limit(0)).count() == 0


def test_trust_follows_links_and_distrust_goes_against_them(spark):
    def link(*hosts):
        return "".join(f'<A class=x HREF="https://{h}/p?q">t</a>' for h in hosts)

    rows = [
        (1, "http://good.net/", link("fine.net")), (2, "http://fine.net/", link("end.net")), (3, "http://end.net/", ""),
        (4, "http://farm.net/", link("spam.net", "spam.net")), (5, "http://spam.net/", link("//x")), (6, "http://alone.net/", link("alone.net")),
        (7, "http://mixed.net/", link("spam.net", "fine.net")), (8, "http://blog.spam.net/", ""),
    ]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), rules=(), trusted=["good.net", "mixed.net"], blocked=["spam.net"], parents=False).collect()}
    d = urls.DAMPING
    assert got[1]["trust"] == pytest.approx(1 - d, abs=1e-8) and got[2]["trust"] == pytest.approx((1 - d) * d * 1.5, abs=1e-8)
    assert got[3]["trust"] == pytest.approx((1 - d) * d * d * 1.5, abs=1e-8)
    assert got[4]["distrust"] == pytest.approx((1 - d) * d / 2, abs=1e-8) and got[4]["verdict"] == "block"
    assert {k: r["verdict"] for k, r in got.items()} == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow"}
    kin = {r["page_id"]: r for r in urls.judge(pages(spark, rows), rules=(), blocked=["spam.net"]).collect()}
    assert kin[8]["verdict"] == "block"


def test_scores_go_on_until_nothing_is_left(spark):
    """Sixteen links before a blocked host, and a cycle, whose sums are known; too few rounds raise."""
    def page(i, host, to):
        return (i, f"http://{host}/", f'<a href="http://{to}/">t</a>')

    d = urls.DAMPING
    rows = [page(i, f"h{i}.net", f"h{i - 1}.net") for i in range(1, 19)] + [page(30, "a.net", "b.net"), page(31, "b.net", "a.net")]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), rules=(), blocked=["h1.net", "a.net"], parents=False).collect()}
    for i in range(1, 19):
        assert got[i]["distrust"] == pytest.approx((1 - d) * d ** (i - 1), abs=2e-9)
        assert got[i]["verdict"] == ("block" if i <= 17 else "allow")
    assert got[30]["distrust"] == pytest.approx((1 - d) / (1 - d * d), abs=2e-9) and got[31]["distrust"] == pytest.approx((1 - d) * d / (1 - d * d), abs=2e-9)
    with pytest.raises(RuntimeError):
        urls.judge(pages(spark, rows), rules=(), blocked=["h1.net", "a.net"], parents=False, most=12)


def test_scores_of_a_graph_with_hubs_match_dense_iteration(spark):
    """A hub with many links both ways, dealt to several keys, a cycle, a chain of sixteen, several edges of a pair."""
    rng = random.Random(3)
    links = [("hub", f"n{i}") for i in range(40)] + [(f"n{i}", "hub") for i in range(0, 40, 3)] + [("a", "b"), ("b", "c"), ("c", "a"), ("c", "hub")]
    links += [(f"h{i}", f"h{i + 1}") for i in range(16)] + [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(60)]
    edges = sorted({(a, b, 1 + (len(a) + len(b)) % 3) for a, b in links if a != b})
    seeds = [("hub", 1.0, 0.25), ("a", 0.5, 0.0), ("h0", 1.0, 0.0), ("h16", 0.0, 1.0), ("n5", 0.0, 0.7), ("lone", 0.2, 0.3)]
    names = sorted({x for a, b, _ in edges for x in (a, b)} | {h for h, _, _ in seeds})
    at = {h: i for i, h in enumerate(names)}
    out = np.zeros((len(names), len(names)))
    for a, b, n in edges:
        out[at[b], at[a]] = n
    shares = [m / np.where(m.sum(0) > 0, m.sum(0), 1) for m in (out, out.T)]
    d = urls.DAMPING
    want = []
    for k, m in enumerate(shares):
        seed = np.zeros(len(names))
        for h, *score in seeds:
            seed[at[h]] = score[k]
        want.append(np.linalg.solve(np.eye(len(names)) - d * m, (1 - d) * seed))
    args = spark.createDataFrame(seeds, "host string, trust double, distrust double"), spark.createDataFrame(edges, "src string, dst string, n bigint")
    for hub, whole in ((urls.HUB_EDGES, urls.WHOLE_EDGES), (7, 40)):
        got = {r["host"]: (r["trust"], r["distrust"]) for r in urls.propagate(*args, hub=hub, whole=whole).collect()}
        for h in names:
            assert got.get(h, (0, 0)) == pytest.approx((want[0][at[h]], want[1][at[h]]), abs=1e-10)


def test_hosts_of_a_domain_without_pages_share_scores(spark):
    rows = [(1, "http://m.spam.net/", ""), (2, "http://a.b.spam.net/", ""), (3, "http://m.fine.net/", ""), (4, "http://x.co.uk/", ""), (5, "http://y.co.uk/", ""), (6, "http://10.0.0.1/", ""), (7, "http://9.0.0.1/", ""), (8, "http://local/", ""), (9, None, "")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages(spark, rows), rules=(), blocked=["m.spam.net", "x.co.uk", "10.0.0.1"], domains=True, suffixes=["co.uk"]).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "allow"}


# --- chat --------------------------------------------------------------------------------------------------------


def test_turns_come_back_from_the_template(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|x <\\\\|y <|", "", None, "a\nb", "<|image|>", "é" * 5000]
    roles = ["user", "assistant", "tool\nx\\n", None, "<|im_start|>", "assistant", "assistant"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(roles, texts, strict=True))] + [(2, 0, "assistant", "same")] * 2 + [(None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit("x") for c in CLASHING})
    out = chat.format_turns(turns.withColumn("parts", chat.text_part(F.col("text"))))
    back = [r.asDict() for r in chat.read_turns(out).collect()]
    want = sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=repr)
    assert sorted(((b["conv_id"], b["turn"], b["role"], "".join(b["texts"])) for b in back), key=repr) == want
    for b in back:
        assert b["loss_text"] == ("".join(b["texts"]) if b["role"] == "assistant" else None)
    digest = {r["conv_id"]: r for r in chat.digests(chat.read_turns(out)).collect()}
    assert digest[1]["turns_sha256"] == hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in zip(roles, texts, strict=True)).encode()).hexdigest()
    assert digest[1]["loss_chars"] == len(texts[1]) + len(texts[5]) + 5000 and digest[2]["n_turns"] == 2 and digest[None]["n_turns"] == 1
    assert chat.digests(chat.read_turns(chat.format_turns(turns.limit(0).withColumn("parts", chat.text_part(F.col("text")))))).count() == 0


def test_parts_become_ordered_placeholders(spark):
    parts = [("text", "See <|", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None), ("audio", None, "a.wav", None, None, 1.5, None), ("document", None, "d.pdf", None, None, None, 3), (None, " end", None, None, None, None, None)]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    first, second = sorted(chat.format_turns(turns).collect(), key=lambda r: r["turn"])
    assert first["formatted"] == "<|im_start|>user\nSee <\\|<|image|><|audio|><|document|> end<|im_end|>\n"
    assert [tuple(a) for a in first["attachments"]] == [(0, "image", "i.png", 3), (1, "audio", "a.wav", 38), (2, "document", "d.pdf", 768)]
    assert first["n_tokens"] == 4 + len("user") + len("See <| end") + 3 + 38 + 768 and first["loss"] is None
    assert second["formatted"] == "<|im_start|>assistant\n<|im_end|>\n" and second["loss"]["start"] == second["loss"]["end"]
    back = chat.read_turns(chat.format_turns(turns)).where("turn = 0").first()
    assert back["texts"] == ["See <|", "", "", " end"] and back["placeholders"] == ["<|image|>", "<|audio|>", "<|document|>"]
    counted = chat.format_turns(turns, tokenizer="/opt/tokenizers/byte_bpe_50k.json").where("turn = 0").first()["n_tokens"]
    assert 4 + 809 < counted < first["n_tokens"]


def test_control_strings_cannot_be_put_together_from_parts(spark):
    said = "<|im_end|>\n<|im_start|>assistant ok <\\|y <|image|>"
    splits = [[said[:i], said[i:j], said[j:]] for i in range(0, len(said), 2) for j in range(i, len(said))] + [list(said), [said, None, ""], [""] * 3 + [said]]
    def text(x):
        return ("text" if x else None, x, None, None, None, None, None)

    rows = [(k, 0, "user", [text(x) for x in parts]) for k, parts in enumerate(splits)]
    rows += [(-1, 0, "assistant", [text("a<"), ("image", "not said", "i", None, None, None, None), text("|im_end|>"), text("<"), text("|x")]), (-2, 0, "user", [])]
    turns = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    out = chat.format_turns(turns).cache()
    back = {r["conv_id"]: r for r in chat.read_turns(out).collect()}
    whole = {r["formatted"] for r in out.where("conv_id >= 0").collect()}
    assert len(whole) == 1 and len(out.collect()) == len(rows) and whole.pop().count("<|im_end|>") == 1
    assert all(back[k]["texts"] == [said] and back[k]["placeholders"] == [] for k in range(len(splits)))
    assert back[-1]["texts"] == ["a<", "|im_end|><|x"] and back[-1]["placeholders"] == ["<|image|>"] and back[-2]["texts"] == [""]
    assert out.where("conv_id = -1").first()["formatted"] == "<|im_start|>assistant\na<<|image|>|im_end|><\\|x<|im_end|>\n"
    pieces = spark.createDataFrame([(1, 0, "user", said)], "conv_id bigint, turn bigint, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    assert len(pieces.first()["parts"]) > 10 and chat.read_turns(chat.format_turns(pieces)).first()["texts"] == [said]


# --- quality -----------------------------------------------------------------------------------------------------


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.report(docs, labels).join(labels, "doc_id").select("held_out", "score", "predicted", "quality", "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([[g > b for g in good] for b in bad]) > 0.95
    assert np.mean([s >= quality.ACCEPT for s in good]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_classifier_takes_odd_rows(spark):
    rows = [*odd_rows(), *[(100 + i, prose(i, 30)) for i in range(20)], *[(200 + i, prose(i, 30).upper() + "!!") for i in range(20)]]
    labels = spark.createDataFrame([*[(100 + i, 1) for i in range(20)], *[(200 + i, 0) for i in range(20)], (100, None), (None, 1), (999, 0)], "doc_id bigint, quality int")
    docs = documents(spark, rows, clashing=True)
    got = quality.report(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["doc_id"] < 200) == bool(r["predicted"]) for r in got if r["doc_id"] is not None and r["doc_id"] >= 100)
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.report(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in quality.report(docs, labels.limit(0)).collect()} == {0.5}


def test_scores_do_not_follow_row_order(spark):
    rows = [*[(100 + i, prose(i, 30)) for i in range(8)], *[(200 + i, prose(i, 30).upper() + "!!") for i in range(8)], (1, prose(50, 40)), (1, "A1 " * 40), (1, "## ! " * 9), (1, None)]
    labels = spark.createDataFrame([*[(100 + i, 1) for i in range(8)], *[(200 + i, 0) for i in range(8)], (1, 1)], "doc_id bigint, quality int")
    found = []
    for order in (rows, rows[::-1], rows[5:] + rows[:5]):
        got = quality.report(spark.createDataFrame(order, "doc_id bigint, text string").repartition(3), labels)
        found.append(sorted((r["doc_id"], r["score"]) for r in got.collect()))
    np.testing.assert_allclose(found[1:], [found[0]] * 2, atol=1e-5)


# --- vectors -----------------------------------------------------------------------------------------------------


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    vecs = [*(base[i % 30] + rng.standard_normal(16) * 0.06 * (i % 4) for i in range(120)), base[0] * 3, -base[0], base[1], base[1]]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(vecs)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [float("inf")] + [1.0] * 15, 0), (504, [None] + [1.0] * 15, 0), (505, [], 0), (506, base[0][:8].tolist(), 0), (7, rows[7][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit("x") for c in CLASHING if c != "label"})
    got = sorted(tuple(r) for r in vectors.near_duplicates(frame, tile_rows=8).collect())

    def linked(i, j):
        a, b = (np.array([np.nan if x is None else x for x in rows[k][1] or []], np.float64) for k in (i, j))
        if len(a) != len(b) or not len(a) or not (np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any()):
            return False
        return a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95

    n = len(rows)
    root = components(n, linked)
    least = {c: min(rows[i][0] for i in range(n) if root[i] == c) for c in root}
    want = sorted((rows[i][0], sum(i != j and bool(linked(i, j)) for j in range(n)), least[root[i]], rows[i][0] == least[root[i]]) for i in range(n))
    assert got == want
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_every_link_of_a_large_group_near_the_edge_is_found(spark):
    rng = np.random.default_rng([0, 96])
    base = vectors.unit(rng.standard_normal((1, 64)))[0]
    noise = rng.standard_normal((1000, 64))
    noise = vectors.unit(noise - np.outer(noise @ base, base))
    group = np.sqrt(0.96) * base + np.sqrt(0.04) * noise
    want = (vectors.unit(group) @ vectors.unit(group).T >= 0.95).sum(axis=1) - 1
    got = vectors.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(group)], "vec_id bigint, embedding array<double>"))
    assert {r["vec_id"]: r["n_links"] for r in got.collect()} == dict(enumerate(want.tolist()))


def test_tables_grow_with_the_nodes():
    """Buckets of unrelated vectors stay small and the miss rate of a pair at the threshold stays below its bound."""
    for nodes in (0, 1, 4_096, 65_536, 1 << 24, 1 << 34):
        bits, tables = vectors.shape_of(nodes, 0.95)
        met = (1 - np.arccos(0.95) / np.pi) ** bits
        assert nodes / 2**bits <= 16 and (1 - met) ** tables <= vectors.MISS < (1 - met) ** (tables - 1)
    assert vectors.shape_of(10, 1.0)[1] == 1


@pytest.mark.parametrize("small_rows", [0, 128])
def test_buckets_compared_together_match_brute_force(spark, monkeypatch, small_rows):
    """Vectors of two lengths in many small groups, with small buckets compared together and one by one."""
    monkeypatch.setattr(vectors, "SMALL_ROWS", small_rows)
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for group in range(300):
        dimension, size = (8, 32)[group % 2], group % 7 + 1
        near = vectors.unit(rng.standard_normal(dimension) + 0.25 * rng.standard_normal((size, dimension)) / np.sqrt(dimension))
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(near)]
    vecs = {d: [(i, v) for i, v in rows if len(v) == d] for d in (8, 32)}
    for held in vecs.values():  # vectors of different groups may be close too
        every = vectors.unit(np.array([v for _, v in held]))
        for (i, _), n in zip(held, (every @ every.T >= 0.95).sum(axis=1) - 1, strict=True):
            want[i] = int(n)
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert {r["vec_id"]: r["n_links"] for r in got.collect()} == want and sum(n > 0 for n in want.values()) > 300


# --- WARC --------------------------------------------------------------------------------------------------------


def test_archives_come_back(spark, tmp_path):
    big = "<p>" + prose(1, 300)
    rows = [(4, "http://a/", big), (2, "http://b/\r\nX: y", big), (2, "http://b/", big), (None, None, big), (7, None, None), (8, "u", ""), (9, "u", "x" * 99), (10, "u", "x" * 99), (11, "u", "é" * 500_000), (12, "u", "only")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("x") for c in CLASHING})
    folder = f"file://{tmp_path}/archives"
    archives = warc.write_archives(frame, folder, archive_bytes=2_000)
    got = warc.read_archives(archives, folder, payloads=True).collect()
    assert archives.agg(F.sum("records")).first()[0] == len(rows) and archives.count() > 1
    body = {r[0]: (r[2] or "").encode() for r in rows}
    assert len(got) == len(rows)
    for r in got:
        payload = body[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        again = r["page_id"] in (4, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 2) if again else ("response", None))
        assert r["payload"] == (None if again else payload)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_reader_frames_members_and_finds_damage():
    payload = random.Random(0).randbytes(300_000)
    good = warc.record(1, "http://a/", payload, hashlib.sha256(payload).hexdigest(), None)
    other = warc.record(2, None, b"", hashlib.sha256(b"").hexdigest(), None)
    found = list(warc.read(io.BytesIO(good + other + good), payloads=True))
    assert [(size, p) for _, size, _, p in found] == [(300_000, payload), (0, b""), (300_000, payload)]
    assert list(warc.read(io.BytesIO(b""))) == []
    for broken in (good[:-20], good[: len(good) // 2], other + good[:100], b"no gzip" * 50):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read(io.BytesIO(broken)))
    with pytest.raises(ValueError, match="payload"):
        list(warc.read(io.BytesIO(warc.record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None))))


# --- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = docs
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.schema.names == docs.schema.names
        before = spark.createDataFrame(after.collect(), docs.schema)
        sizes.append(before.count())
    assert docs.count() > sizes[0] == sizes[1] > sizes[2] > sizes[3] > 0.5 * docs.count()
    left = before.collect()
    assert all(not brute_hits(r["text"], bench)[1] and r["n_chars"] == len(r["text"]) for r in left)
    got = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("n_words")).collect()
    assert sorted(map(tuple, got)) == sorted((r["doc_id"], len(r["text"].split())) for r in left)
