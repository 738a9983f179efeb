"""Token counts, fill-in-middle and whitening over odd tables and against brute force."""

import hashlib
import json
import random
import re
from decimal import Decimal

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellspark.llm import infill, queries, tokens, whitening
from tests.llm.builders import CLASHING, documents, odd_rows, prose

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- token counts ------------------------------------------------------------------------------------------------

STRANGE = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "I'll they've 's''s 're'd", "  a \n\n b\t\t 　c  ", "ſſ𝔘𝔫ᶜⅧ½ ٣٤ ꙮ‍👩‍👩‍👧 ͸", "한국어 日本語 русский 12,345.67", "\x00\x1f\x85 x", "é" * 3_000, "ab" * 20_000, "- " * 5_000]


def library(path, texts):
    known = Tokenizer.from_file(path)
    return [len(known.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_the_library_s(spark, name):
    path = public_tokenizers.path(name)
    rows = [*odd_rows(), *[(100 + i, t) for i, t in enumerate(STRANGE)], (7, "x " * 1025)]
    got = tokens.count_tokens(documents(spark, rows, clashing=True), path, ["doc_id", "text", *CLASHING]).collect()
    want = [(k, t, len((t or "").encode()), n) for (k, t), n in zip(rows, library(path, [t for _, t in rows]), strict=True)]
    assert sorted(((r["row"]["doc_id"], r["row"]["text"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["row"]["size"] == "extra size" for r in got)


def test_whole_table_and_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r["doc_id"]: n for r, n in zip(docs, library(BPE, [r["text"] for r in docs]), strict=True)}
    got = queries.QUERIES["op11_token_counts"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got.collect())
    assert tokens.report(documents(spark, []), BPE).count() == 0
    edge = documents(spark, [(1, "x" + " x" * 1023), (2, "x" + " x" * 1024)])
    assert {r["doc_id"]: r["over_limit"] for r in tokens.report(edge, BPE).collect()} == {1: False, 2: True}


def test_small_blocks_give_the_same(spark, monkeypatch):
    """The generator that cuts blocks, fed by hand: every block lists each of its pre-tokens once."""
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(tokens, "TaskContext", Task)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 200)
    monkeypatch.setattr(tokens, "PIECES_AT_ONCE", 7)
    said = [prose(i % 4, 20) for i in range(12)]
    batch = pa.RecordBatch.from_arrays([pa.array([{"text": t} for t in said])], ["row"])
    out = list(tokens._blocks(iter([batch]), BPE, "text", tokens._NAMES, batch.schema.field("row").type))
    lists, rows = {}, []
    for r in (r for b in out for r in b.to_pylist()):
        if r["first"] is None:
            rows.append(r)
        else:
            assert len(lists.setdefault(r["block"], [])) == r["first"] and len(r["pieces"]) <= 7
            lists[r["block"]] += r["pieces"]
    assert len(lists) > 3 and min(lists) == 3 << 32 and all(len(p) == len(set(p)) for p in lists.values())
    known = tokens.cutter(BPE)
    for r, n in zip(rows, library(BPE, said), strict=True):
        at, times = tokens.decode(r["entries"])
        assert sum(t * known.count(lists[r["block"]][a]) for a, t in zip(at.tolist(), times.tolist(), strict=True)) == n


def test_numbers_come_back_from_planes():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 255), (700, 256), (900, 70_000), (50, 1 << 25)):
        numbers, counts = rng.permutation(max(top, n))[:n] if top < 1e6 else np.unique(rng.integers(0, top, n)), None
        counts = rng.integers(1, 400, len(numbers))
        at, times = tokens.decode(tokens.encode(numbers, counts))
        assert dict(zip(at.tolist(), times.tolist(), strict=True)) == dict(zip(numbers.tolist(), counts.tolist(), strict=True))


def test_both_engines_agree_on_every_agreed_character():
    known = tokens.cutter(BPE)
    assert known.byte_level
    for code in (c for c in range(0x110000) if not 0xD800 <= c < 0xE000):
        ch = chr(code)
        if tokens.AGREED.fullmatch(ch):
            text = f"a{ch}1{ch} {ch}.{ch}  {ch}"
            assert known.pattern.findall(text) == [text[a:b] for _, (a, b) in known.tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def test_unknown_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError, match="JSON"):
        tokens.Cutter(public_tokenizers.path("piece_bpe_32k.model"))
    file = json.load(open(BPE))
    file["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(file))
    with pytest.raises(ValueError, match="surroundings"):
        tokens.Cutter(str(tmp_path / "t.json"))


# --- fill-in-middle ----------------------------------------------------------------------------------------------


def brute_infill(key, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest, n = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest(), len(units)
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, None, text
    spm = h[3] % 100 < 80
    return n, "spm" if spm else "psm", pre, mid, suf, f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"


def test_infill_matches_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    marks = [" ", "\n", "\t\x0b\x0c\r", "a", "é", "　", "\x00", "<", "P", "<P", ">", "\x85", "𝔘"]
    rows = [*odd_rows(), *[(1000 + i, "".join(rng.choices(marks, k=rng.randint(0, 30)))) for i in range(300)]]
    rows += [(20 + i, f"one {s} two") for i, s in enumerate(["<P>", "<S>", "<M>", "<P", "<p>"])] + [(i, prose(i, 60)) for i in range(200, 260)]
    docs = documents(spark, rows, clashing=True)
    for at_once in (infill.BYTES_AT_ONCE, 100):
        monkeypatch.setattr(infill, "BYTES_AT_ONCE", at_once)
        got = infill.fill_in_middle(docs, ["doc_id", "text", *CLASHING]).withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
        assert sorted(((r["row"]["doc_id"], r["row"]["text"], *r[1:7]) for r in got), key=repr) == sorted(((k, t, *brute_infill(k, t)) for k, t in rows), key=repr)
        assert all(r["again"] == (r["row"]["text"] or "") and r["row"]["block"] == "extra block" for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.report(docs.limit(0)).count() == 0


def test_infill_report(spark):
    rows = [*odd_rows(), *[(300 + i, prose(i, 9) + " é") for i in range(40)]]
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for key, text in rows:
        n, form, pre, mid, _, out = brute_infill(key, text)
        want.append((key, n, form, None if pre is None else len(pre), None if mid is None else len(mid), sha(out), sha(text or "")))
    assert sorted(map(repr, map(tuple, infill.report(documents(spark, rows, clashing=True)).collect()))) == sorted(map(repr, want))


# --- whitening ---------------------------------------------------------------------------------------------------


def brute_whitening(rows, components=16):
    """(by key and component: n, deviation, whitened with any sign, explained) with dense numpy."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = {k: np.array([int(np.floor(64 * float(c))) + 1_000_000 for c in v], object) for k, v in kept}
    distinct = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = np.array([[float(Decimal(int(n * c - s)) / n) for c, s in zip(r, sums, strict=True)] for r in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for k, v in x.items():
        away = n * v - sums
        out[k] = n, int((away * away).sum()), (away / n).astype(float) @ vectors / np.sqrt(values), values / np.trace(covariance)
    return out


def check(got, want, count, atol=1e-8):
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert by.keys() == want.keys()
    signs = None
    for key, (n, deviation, white, explained) in want.items():
        rows = by[key]
        assert sorted(rows) == list(range(1, count + 1))
        mine = np.array([rows[c]["whitened"] for c in range(1, count + 1)])
        if signs is None:
            signs = np.sign(mine * white[:count])
        np.testing.assert_allclose(mine * signs, white[:count], atol=atol)
        np.testing.assert_allclose([rows[c]["explained"] for c in range(1, count + 1)], explained[:count], rtol=1e-10)
        assert all((r["n"], r["deviation"]) == (n, deviation) for r in rows.values())
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_matches_dense_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 24)) * np.linspace(0.3, 2, 24) + np.linspace(-5, 5, 24)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector holds over a third
    rows += [(2000, None), (2001, [None] + [0.0] * 23), (2002, [float("nan")] * 24), (2003, [float("inf")] + [0.0] * 23)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({c: F.lit("x") for c in [*CLASHING, "grid", "n", "whitened", "component"]})
    got = whitening.report(frame.repartition(7)).collect()
    check(got, brute_whitening(rows), 16)
    # the fit is the same to the last bit, whatever the order of rows
    fits = [whitening.fit(*whitening.fitted_rows(frame.repartition(k).select(whitening.grid("embedding").alias("grid")))) for k in (1, 9)]
    assert (fits[0].moments.covariance == fits[1].moments.covariance).all() and (fits[0].vectors == fits[1].vectors).all()


def test_whitening_of_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, SF).collect(), brute_whitening(rows), 16)


def test_whitening_of_odd_tables(spark):
    def run(rows):
        return whitening.report(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [1.0, 2.0])] * 3) == [] and run([(1, []), (2, [])]) == []
    rows = [(1, [0.0, 1.0, 5.0]), (2, [1.0, 0.0, 5.0]), (None, [1.0, 0.0, 5.0]), (2, [1.0, 0.0, 5.0])]  # rank one
    got = run(rows)
    assert len(got) == 4 and {r["component"] for r in got} == {1} and all(abs(abs(r["whitened"]) - 1) < 1e-12 and r["explained"] == pytest.approx(1) for r in got)
    short = run([(1, [3.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0])])  # a short vector has zeros at its end
    assert {r["n"] for r in short} == {2} and len({r["whitened"] for r in short if r["vec_id"] < 3}) == 1
    huge = whitening.transform(spark.createDataFrame([(1, [1e300, 1.0])], "vec_id bigint, embedding array<double>"), whitening.Whitening(whitening.Moments(2, [0, 0], np.eye(2)), np.ones(2), np.eye(2)), ["vec_id"]).first()
    assert int(huge["deviation"]) == (2 << 40) ** 2 + 128**2


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(v), float(i % 7)]) for i, v in enumerate([3e8, -3e8, 2.5e8, 1.0, 7e7])]
    got = whitening.fitted_rows(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select(whitening.grid("embedding").alias("grid")))
    found = whitening.moments(*got)
    x = np.array([[int(64 * c) for c in v] for _, v in rows], object)
    assert found.n == 5 and found.sums == x.sum(axis=0).tolist()
    n, s = 5, x.sum(axis=0)
    assert found.covariance[0, 0] == (n * (x[:, 0] ** 2).sum() - s[0] ** 2) / n**2


@pytest.mark.parametrize("spectrum", ["spread", "equal", "clusters", "falling", "rank", "power", "crowded"])
def test_eigenpairs_of_hard_spectra(spark, spectrum):
    rng = np.random.default_rng(8)
    size = 60
    values = {
        "spread": np.linspace(1, 60, size), "equal": np.full(size, 3.0), "clusters": np.repeat([1.0, 1 + 1e-9, 5, 5 + 1e-7, 40, 41], 10),
        "power": 100 / np.arange(1, size + 1.0) ** 1.5, "crowded": 1 + np.arange(size) * 1e-6,
        "falling": 2.0 ** -np.arange(size), "rank": np.append(np.zeros(size - 5), [1, 2, 2, 3, 100.0]),
    }[spectrum]
    turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
    matrix = turn * values @ turn.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading(spark, matrix)
    want = np.sort(values)[::-1][:16]
    want = want[want > 1e-12 * values.max()]
    np.testing.assert_allclose(got, want, rtol=1e-10, atol=1e-12 * values.max())
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-9)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-11 * values.max()


def test_counts_of_inertia():
    rng = np.random.default_rng(9)
    for size in (1, 2, 3, 17):
        a = rng.standard_normal((size, size))
        a = a + a.T
        shifts = np.linspace(-10, 10, 41)
        assert whitening.above(whitening.tridiagonal(a), shifts).tolist() == [(np.linalg.eigvalsh(a) > s).sum() for s in shifts]
