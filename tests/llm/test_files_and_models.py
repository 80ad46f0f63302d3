import gzip
import hashlib
import math
import os
import random
import shutil
import subprocess
import sys
import zlib
from collections import Counter
from datetime import datetime
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import piece_sampling, token_files, toxicity, warc

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_loser_tree_merges_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted((rng.randrange(9), r) for _ in range(rng.randrange(12))) for r in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert merged == sorted((x for r in runs for x in r), key=lambda x: x[0]) and [x[0] for x in merged] == sorted(x[0] for r in runs for x in r)


def pages():
    long = "é" * 700
    html = [long, long, "short", "short", None, "", "a\r\n\r\nWARC/1.1\r\n", "x" * 300_000, long]
    url = ["http://b.example/x", "https://www.a.example:80/Q?b#c", None, "http://a.example/q%20\r\ny", "", "a.example", "b.example/x", "u", "http://b.example/x"]
    rows = [(i, u, h) for i, (u, h) in enumerate(zip(url, html, strict=True))]
    return rows + [(8, url[8], html[8]), (None, "n", long), (20, "hot", "p")] + [(30 + k, "http://hot.example/", f"{k} " * 600) for k in range(60)]


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BATCH_ROWS", 7)
    rows = pages()
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, digest string, leader int")
    path = str(tmp_path / "warc")
    index = warc.capture_index(df, path, archive_bytes=40_000)
    got = index.collect()
    large = Counter(h for _, _, h in rows if h and len(h.encode()) >= 1000)
    lead = {h: max(i for i, _, x in rows if x == h and i is not None) for h in large}
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = large.get(h, 0) > 1 and i != lead[h]
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", lead[h] if revisit else None))
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, (tuple(r[f] for f in fields) for r in got))) == sorted(map(str, want))
    assert {(r["page_id"], r["url"]) for r in got} == {(i, u) for i, u, _ in rows}
    # Globally ordered, with nulls first, across partitions.
    keys = [warc._null_first([r[c] for c in warc._ORDER]) for r in got]
    assert keys == sorted(keys) and len({r["archive"] for r in got}) > 3
    assert {r["url_key"] for r in got if r["page_id"] == 1} == {"example,a)/q?b"}
    # Offsets lead to the records, and inside an archive captures come in index order.
    r = next(r for r in got if r["page_id"] == 7)
    content = open(f"{path}/{r['archive']}", "rb").read()
    record = next(warc.parse_archive(content[r["record_offset"] : r["record_offset"] + r["record_bytes"]]))
    assert bytes(record["payload"]) == b"x" * 300_000
    assert gzip.compress(content) and warc.read_archives(spark, path).count() == len(rows)


def test_archives_of_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.capture_index(none).count() == 0


def test_captured_times_are_kept(spark):
    df = spark.createDataFrame([(1, "u", "x", datetime(2020, 5, 1, 1, 2, 3, 450000)), (2, "u", "x", None)], "page_id long, url string, html string, at timestamp")
    got = {r["page_id"]: r["captured"] for r in warc.capture_index(df, captured="at").collect()}
    assert got == {1: datetime(2020, 5, 1, 1, 2, 3, 450000), 2: None}


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], [0, 1, 2, 3], [7, 7, 10**12, 10**12 + 1], list(range(0, 90_000, 3))])
def test_elias_fano(values):
    coded = token_files.EliasFano.encode(np.array(values, dtype=np.uint64))
    back = token_files.EliasFano.from_bytes(memoryview(coded.to_bytes()))
    assert back.values().tolist() == values and len(back) == len(values)
    for i in range(0, len(values), max(1, len(values) // 50)):
        assert back[i] == values[i]
    if len(values) > 1000:
        assert len(coded.to_bytes()) < len(values)


def token_texts():
    rng = random.Random(8)
    parts = ["a", " ", "  ", "\n", "\t", " \n", "'s", "é", "日本", "🎉", " ", "　", "<|endoftext|>", "12", "!?", "word", "\x1c", "​"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]


def test_token_files_against_the_tokenizer(spark, tmp_path, monkeypatch):
    for name, value in (("BLOCK_BYTES", 2000), ("BLOCKS_PER_FILE", 2), ("CACHED_PIECES", 300)):
        monkeypatch.setattr(token_files, name, value)
    texts = [*token_texts(), None, "", "long text " * 30_000]
    rows = [(i * 7 - 40 if i % 50 else None, t) for i, t in enumerate(texts)] + [(9, "twice"), (9, "twice")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, value int").repartition(3)
    path = str(tmp_path / "tokens")
    got = token_files.tokenize_to_files(df, BPE, path).orderBy("start").collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r["key"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    assert [r["key"] or 0 for r in got if r["key"] is not None] == sorted(r[0] for r in rows if r[0] is not None)
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])[:-1])).tolist()
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(files) > 2
    block = next(token_files.blocks_of(open(f"{path}/{files[0]}", "rb").read()))
    assert [len(block.document(i)) for i in range(len(block.keys))] == np.diff(np.concatenate(([0], block.boundaries.values()))).tolist()


def test_token_files_of_no_documents(spark):
    assert token_files.tokenize_to_files(spark.createDataFrame([], "doc_id long, text string"), BPE).count() == 0


def segmentations(pieces, text):
    """Every way to spell a text, with its weight."""
    if not text:
        return {(): 1.0}
    out = {}
    for n in range(1, min(len(text), pieces.longest) + 1):
        if text[:n] in pieces.weights:
            i, w = pieces.weights[text[:n]]
            out |= {(i, *rest): w * v for rest, v in segmentations(pieces, text[n:]).items()}
    return out


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_segmentations_are_drawn_by_their_weight(alpha):
    sampler = piece_sampling.Sampler(PIECES, alpha)
    want = segmentations(sampler.pieces, " this")
    n = 40_000
    ids, counts = sampler.encode(["this"] * n, piece_sampling._mix(np.arange(n, dtype=np.uint64)))
    ends = np.cumsum(counts)
    got = Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True))
    assert set(got) <= set(want)
    for way, weight in want.items():
        p = weight / sum(want.values())
        assert abs(got[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_long_parts_are_drawn_like_short_ones(monkeypatch):
    text = "antidisestablishment"
    short = piece_sampling.Sampler(PIECES, 0.7)
    want = Counter(short.encode([text] * 4000, piece_sampling._mix(np.arange(4000, dtype=np.uint64)))[1].tolist())
    monkeypatch.setattr(piece_sampling, "LONG_PART", 3)
    got = Counter(piece_sampling.Sampler(PIECES, 0.7).encode([text] * 4000, piece_sampling._mix(np.arange(4000, dtype=np.uint64)))[1].tolist())
    assert all(abs(want[k] - got[k]) < 200 for k in {*want, *got})


def test_cumulative_probabilities_do_not_depend_on_other_parts():
    rng = random.Random(4)
    parts = sorted({" " + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 12))) for _ in range(3000)})
    together = piece_sampling.Sampler(PIECES, 1.0)
    together._learn(parts)
    alone = piece_sampling.Sampler(PIECES, 1.0)
    for part in parts[::7]:
        alone._forget()
        alone._learn([part])
        last = together.ends[part] + 1
        mine = slice(together.first_arc[last - len(part)], together.first_arc[last])
        assert alone.cumulative.dtype == np.float64
        assert together.cumulative[mine].tolist() == alone.cumulative.tolist(), part


def test_pieces_decode_to_the_text(spark, monkeypatch):
    monkeypatch.setattr(piece_sampling, "KEPT_PARTS", 200)
    monkeypatch.setattr(piece_sampling, "BATCH_CHARS", 500)
    parts = ["▁", " ", "  ", "\n", "é", "日", "🎉", "the", "x", "\t", " ", "ing", "\u0000"]
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(None, "null key"), (None, None), (300, ""), (301, "y" * 30_000), (302, "word " * 20_000), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, _text int, piece_ids string")
    one = piece_sampling.decode(piece_sampling.encode(df, PIECES, keep=("text",)), PIECES).collect()
    assert sorted(map(str, ((r["doc_id"], r["decoded"]) for r in one))) == sorted(map(str, rows))
    assert all((r["piece_ids"] is None) == (r["text"] is None) for r in one)
    # The same however the rows are dealt out, and another seed draws others.
    again = piece_sampling.encode(df.repartition(5), PIECES, keep=("text",)).collect()
    ids = lambda found: sorted(str((r["doc_id"], r["text"], r["piece_ids"])) for r in found)
    assert ids(one) == ids(again) != ids(piece_sampling.encode(df, PIECES, seed=1, keep=("text",)).collect())
    assert piece_sampling.encode(df.limit(0), PIECES).count() == 0


DATA = "/root/testdata/sf0.01"


def test_chain_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    chain = toxicity.fit_chain(docs, labels.where(~held_out), ("low_quality", "toxic"), feature_words=300)
    # The second model sees the probability of the first beside the words.
    assert chain.models[1].numFeatures == chain.models[0].numFeatures + 1
    told = toxicity.score(docs, chain).join(labels.where(held_out), "doc_id")
    right = told.agg(F.avg(((F.col("p_toxic") >= 0.5).cast("int") == F.col("toxic")).cast("double"))).first()[0]
    assert right > 0.95
    kept = toxicity.reject_toxic(docs, chain)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    odd = spark.createDataFrame([(None, None, 1, "x"), (1, "", 2, "y"), (1, "", 2, "y")], "doc_id long, text string, _bag int, p_toxic string")
    assert toxicity.score(odd, chain).count() == 3 and toxicity.reject_toxic(odd, chain).columns == odd.columns


def test_chain_without_labels_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, low_quality int, toxic int")
    chain = toxicity.fit_chain(docs, labels, ("low_quality", "toxic"))
    assert toxicity.reject_toxic(docs, chain).count() == 2
    one_sided = spark.createDataFrame([(1, 0, None), (2, 0, 1), (None, 1, 1)], "doc_id long, low_quality int, toxic int")
    assert toxicity.score(docs, toxicity.fit_chain(docs, one_sided, ("low_quality", "toxic"))).count() == 2


def test_the_rest_works_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", check=True, timeout=120, env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")})
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and all(any(k.startswith(f'op{n}_') for k in q) for n in range(1, 11))"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, check=True, timeout=120)


def test_products_of_parts_cut_where_the_pattern_cuts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    encoder = token_files.PieceEncoder(BPE)
    texts = ["".join(p) for p in product(["a", " ", "\n", "'s", " ", "1", "!", "<|endoftext|>"], repeat=4)]
    assert 50256 in plain.encode("a<|endoftext|>", add_special_tokens=False).ids
    for text, coded in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(coded, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_files_are_small_and_read_without_a_copy(monkeypatch):
    data = b"".join(token_files.pack_block([i], [np.array([i, 0], dtype="<u2").tobytes()], 2) + b"\n" for i in range(3))
    seen, real = [], token_files.blocks_of
    monkeypatch.setattr(token_files, "blocks_of", lambda content: seen.append(content) or real(content))
    batch = pa.RecordBatch.from_pydict({"path": ["f"], "content": pa.array([data], pa.binary())})
    rows = pa.Table.from_batches(token_files._rows(iter([batch]))).to_pylist()
    assert [(r["key"], r["start"], r["n_tokens"]) for r in rows] == [(0, 0, 2), (1, 2, 2), (2, 4, 2)]
    assert isinstance(seen[0], pa.Buffer) and token_files.BLOCKS_PER_FILE * token_files.BLOCK_BYTES <= 8 << 20
