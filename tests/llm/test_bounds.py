"""Seams of byte-level BPE in vocabularies that join white space, and bounds of the toxicity sample that hold."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np

from curatrix.llm import byte_bpe, toxicity
from curatrix.llm.encoders import rank_file
from curatrix.sources.session import ship_code


def test_seams_after_white_space(spark, tmp_path):
    ship_code(spark)
    extra = [b"\n\n", b"\t\t", b"  ", b" \n", b"\n\n\n", b"ab", b" a"]
    path = tmp_path / "joined.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {k}\n" for k, t in enumerate([*(bytes([b]) for b in range(256)), *extra])))
    rng = random.Random(3)
    bodies = ["".join(rng.choice(["x", "foo", "ab", " ", "\n\n", "\n", "\t\t", "  ", "é", "9", "'s", "!\n"]) for _ in range(200)) for _ in range(80)]
    bodies += ["a" * (60 - k) + "x\n\nfoo bar baz\n\n\nqux" * 10 for k in range(20)] + ["\n" * 300, " " * 300 + "x", ""]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").repartition(3)
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in byte_bpe.encode_documents(docs, str(path), chunk=64, overlap=16).collect()}
    encoder = rank_file(str(path))
    assert got == {k: encoder.encode_ordinary(t) for k, t in enumerate(bodies)}
    cuts = byte_bpe.seams(byte_bpe.boundaries(byte_bpe.chunked(docs.withColumnRenamed("doc_id", "id"), 64, 16), 64, 16))
    assert cuts.where("not whole").count() > 100  # texts are still cut


def test_the_sample_is_bounded_whatever_one_id_has(spark, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 50)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 80)
    toxic_id = next(i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2)  # not held out
    rows = [(toxic_id, f"bad text {k}") for k in range(900)] + [(toxic_id, "same bad text")] * 900 + [(1000 + k, f"plain text {k % 40}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(toxic_id, 0, 1), (1001, 1, 0)], "doc_id long, quality int, toxic int")
    sample, _ = toxicity.sampled(docs, labels)
    assert sample.where("toxic").count() == 50 and sample.where("unlabelled").count() <= 80
