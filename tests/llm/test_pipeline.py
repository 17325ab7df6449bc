"""The pipeline's rows against plain code, stage by stage, each on what the plain stage before it kept."""

import math
import re
import struct
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_operators import plain_targets
from wavequill.llm import entries, language_id
from wavequill.llm.common import table


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_languages(spark, docs):
    m = language_id.train(table(spark, SF, "documents"))
    kept = []
    for r in docs:
        h, n = m.entropies([r.text])
        if n[0]:
            k = int(np.argmin(h[0]))
            reached = sum(n[0] >= x for x in language_id.LENGTHS[1:])
            if h[0][k] <= m.bounds[m.langs[k]][reached]:
                kept.append(r)
    return kept


def plain_copies(docs):
    least = {}
    for r in docs:
        least[r.text] = min(least.get(r.text, r.doc_id), r.doc_id)
    return [r for r in docs if least[r.text] == r.doc_id]


def plain_near(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, lists, parent = {}, defaultdict(list), {r.doc_id: r.doc_id for r in docs}
    for r in docs:
        w = words_of((r.text or "").translate(lower))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        for s in sets[r.doc_id]:
            lists[s].append(r.doc_id)

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for (a, b), n in Counter(p for x in lists.values() for p in combinations(sorted(x), 2)).items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return [r for r in docs if root(r.doc_id) == r.doc_id]


def seeded(doc_id, size):
    h = xxhash.xxh64_intdigest(struct.pack("<i", 42), 42)
    for x in (doc_id, size):
        h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
    return h - (1 << 64) if h >> 63 else h


def check_mix(docs, got):
    """got: how often each document is taken. Whole passes first; the rest is the largest sum within the budget, and of each
    length the documents of the least hashes."""
    size = {r.doc_id: len(words_of(r.text)) for r in docs}
    own, sizes = defaultdict(list), Counter()
    for r in docs:
        own[r.source].append(r.doc_id)
        sizes[r.source] += size[r.doc_id]
    for source, target in plain_targets(sizes).items():
        passes = min(2, math.floor(target / sizes[source]))
        extra = [d for d in own[source] if got[d] > passes]
        assert all(got[d] - passes in (0, 1) for d in own[source])
        budget = round(target) - passes * sizes[source] if passes < 2 else 0
        sums = 1
        for d in own[source]:
            sums |= sums << size[d]
        best = (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1
        assert sum(size[d] for d in extra) == best
        for n in {size[d] for d in own[source]}:
            ranked = sorted((d for d in own[source] if size[d] == n), key=lambda d: seeded(d, n))
            taken = [d for d in ranked if d in set(extra)]
            assert taken == ranked[: len(taken)]


def test_pipeline_equals_plain_code(spark):
    docs = table(spark, SF, "documents").collect()
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    kept, frame = docs, table(spark, SF, "documents")
    for name, plain in zip(names[:3], (lambda d: plain_languages(spark, d), plain_copies, plain_near), strict=True):
        kept, frame = plain(kept), stages[name](spark, frame, SF)
        assert sorted(r.doc_id for r in frame.collect()) == sorted(r.doc_id for r in kept), name
    out = corpus_pipeline.run(spark, SF).collect()
    got, text = Counter(r.doc_id for r in out), {r.doc_id: r.text for r in kept}
    assert set(got) <= set(text)
    check_mix(kept, got)
    model = SentencePieceProcessor(model_file=entries.PIECE_MODEL)
    assert all(r.ids == model.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip for r in out)
