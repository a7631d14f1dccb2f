"""Fill-in-middle outputs against a plain version, with frames of a few bytes."""

import hashlib
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from pageloom.llm import fill_in_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
SCHEMA = "doc_id long, text string, n long, frames string, form string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = _sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text, text)
    prefix, middle, suffix = ("".join(p) for p in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        out, form = f"<S>{suffix}<P>{prefix}<M>{middle}", "spm"
    else:
        out, form = f"<P>{prefix}<S>{suffix}<M>{middle}", "psm"
    return (doc_id, n, form, len(prefix), len(middle), out, text)


def _texts():
    rng = random.Random(5)
    kinds = ["ab", "Word", " ", "\n", "é", "中", "𝒳", "<", ">", "P>", "<P", "1", ",", "\0"]
    rows = [(i, "".join(rng.choice(kinds) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "a"), (403, "a<M>b"), (404, "x" * 5000), (405, "é" * 3000)]
    rows += [(None, "no id here"), (406, "<P" + ">" * 3), (7, rows[7][1]), (407, "z" * 40 + "<S>" + "z" * 40)]
    return rows


def _got(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("frame_bytes", [4, 7, 64, 1 << 16])
def test_outputs_equal_plain_version(spark, frame_bytes):
    rows = _texts()
    docs = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in rows], SCHEMA).repartition(3)
    cut = fim.with_cuts(fim.write_frames(docs, frame_bytes=frame_bytes))
    out = fim.fill_in_middle(cut, frame_bytes=frame_bytes)
    expected = [_plain(i, t) for i, t in rows]
    hashed = sorted(repr((*e[:5], _sha(e[5]), _sha(e[6]))) for e in expected)
    assert _got(fim.output_digests(out)) == hashed
    texts = [
        b"".join(zstandard.ZstdDecompressor().decompress(f) for f in r.frames).decode()
        for r in out.collect()
    ]
    assert sorted(texts) == sorted(e[5] for e in expected)
    assert len({e[2] for e in expected}) == 3


def test_frames_are_bounded_and_counted(spark):
    text = "abc déf " * 500
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = fim.write_frames(docs, frame_bytes=100).first()
    unpack = zstandard.ZstdDecompressor().decompress
    parts = [unpack(f.data) for f in row.frames]
    assert b"".join(parts).decode() == text and max(map(len, parts)) <= 100
    at = 0
    for frame, part in zip(row.frames, parts):
        assert frame.chars == at
        at += len(part.decode())
    assert (row.n, row.n_chars) == (len(UNIT.findall(text)), len(text))


def test_restoring_reads_the_output_only(spark):
    docs = spark.createDataFrame([(1, "some words, and more of them")], "doc_id long, text string")
    out = fim.fill_in_middle(fim.with_cuts(fim.write_frames(docs))).filter("form <> 'plain'")
    broken = out.withColumn("frames", F.array(F.lit(zstandard.compress(b"<P>no other mark"))))
    if not out.isEmpty():
        with pytest.raises(Exception, match="lacks a mark"):
            fim.output_digests(broken).collect()


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.output_digests(fim.fill_in_middle(fim.with_cuts(fim.write_frames(docs)))).collect() == []
