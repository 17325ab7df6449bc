"""Decoders on what others wrote, and odd columns."""

import random

import numpy as np
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tests.conftest import SF
from wavequill.llm import entries, html_blocks, media_columns, sentence_pieces, url_filters
from wavequill.llm.common import table


def test_decoded_pieces_equal_the_library(spark):
    model, r = SentencePieceProcessor(model_file=entries.PIECE_MODEL), random.Random(4)
    texts = ["", " a", "a  b", "é日本𝕏", "line\nline", *("".join(r.choice("abcdeéintros  ▁AT.\n") for _ in range(r.randrange(60))) for _ in range(200))]
    rows = [(i, model.encode(t)) for i, t in enumerate(texts)] + [(-1, None), (-2, [])]
    got = {x.doc_id: x.text for x in sentence_pieces.decode_pieces(spark.createDataFrame(rows, "doc_id long, ids array<int>"), entries.PIECE_MODEL).collect()}
    assert got == {**{i: model.decode(model.encode(t)) for i, t in enumerate(texts)}, -1: None, -2: ""}


def test_pixel_arrays(spark):
    payloads = [b"", b"abc", bytes(range(256)) * 5, random.Random(1).randbytes(5000), "wörd ".encode() * 400]
    rows = spark.createDataFrame(list(enumerate(payloads)), "doc_id long, payload binary")
    stored = media_columns.as_media(rows, F.col("payload"), ["doc_id"])
    bad = spark.createDataFrame([(90, b"RIFF"), (91, b""), (92, None)], "doc_id long, media binary")
    got = {r.doc_id: r for r in media_columns.pixel_arrays(stored.select("doc_id", "media").unionByName(bad), "media", ["doc_id"]).collect()}
    for i, p in enumerate(payloads):
        own = got[i]
        data = np.array(own.argb, np.uint64).astype("<u4").tobytes()
        assert own.height * own.width == len(own.argb) and data[: max(64, -(-len(p) // 64) * 64)] == media_columns.padded(p)
    assert all(got[k].height is None and got[k].argb is None for k in (90, 91, 92))


def test_pages_with_clashing_columns(spark):
    pages = table(spark, SF, "pages").limit(30)
    odd = pages.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "text", "n_chars", "id")})
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert key(url_filters.filter_urls(odd)) == key(url_filters.filter_urls(pages))
    model = html_blocks.train(pages, made_up=20)
    assert key(html_blocks.extract(odd, model)) == key(html_blocks.extract(pages, model))
