"""Each stage of the pipeline against a plain version over the rows that the stage before kept."""

import hashlib
import os
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from careerlake.llm import mixing, quality, simhash, toxicity
from careerlake.llm.common import held_out, read
from careerlake.llm.merge_dropout import Segmenter
from careerlake.llm.queries import vocabulary

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


def topic(text, tokens):
    if "icense" in text or "ights reserved" in text:
        return "legal"
    if sum(c in "0123456789" for c in text) * 20 > len(text):
        return "figures"
    return "brief" if tokens <= 100 else "long" if tokens > 2000 else "prose"


def test_stages_against_plain_versions(spark):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    text = lambda i: rows[i].text or ""

    clean = stages["toxicity"](spark, docs, SF)
    score = toxicity.fit(docs, labels, ~held_out(3, 1)).scorer()
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {i for i in rows if score(text(i)) < 0.7}

    good = stages["quality"](spark, clean, SF)
    model = quality.fit(quality.document_statistics(clean), labels, ~held_out(4, 2))
    better = {r.doc_id for r in good.collect()}
    assert better == {i for i in kept if model.score(np.array([quality.statistics(text(i).encode())]))[0] >= 0.7}

    one = stages["simhash"](spark, good, SF)
    prints = {i: simhash.fingerprint(text(i).encode()) for i in sorted(better)}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            least = min(group[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3)
            changed |= least < group[a]
            group[a] = min(group[a], least)
    alone = {r.doc_id for r in one.collect()}
    assert alone == {i for i, g in group.items() if i == g}

    mixed = stages["mixing"](spark, one, SF)
    tokens = {i: len(text(i).encode().split()) + 1 for i in alone}
    key = {i: (rows[i].source, rows[i].lang, topic(text(i), tokens[i])) for i in alone}
    cells = Counter()
    for i in alone:
        cells[key[i]] += tokens[i]
    keys, w = list(cells), np.array(list(cells.values()), float)
    raked = w / w.sum()
    for _ in range(mixing.ROUNDS):
        for d, power in enumerate(mixing.EXPONENTS.values()):
            at = np.unique([repr(k[d]) for k in keys], return_inverse=True)[1]
            want = np.bincount(at, w) ** power
            raked *= (want / want.sum())[at] / np.bincount(at, raked)[at]
    draws = dict(zip(keys, mixing.SHARE * w.sum() * raked / w / raked.sum(), strict=True))
    u = {i: int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52 for i in alone}
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[i] == int(draws[key[i]]) + (u[i] < draws[key[i]] % 1) for i in alone)

    coded = stages["encoding"](spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in coded) == times
    s = Segmenter(vocabulary("piece_bpe_32k.model"), 0.1, 5)
    assert all(s.decode(np.array(r.ids)) == text(r.doc_id) and r.lossless for r in coded)
    assert {(r.doc_id, r.digest) for r in corpus_pipeline.run(spark, SF).collect()} == {(r.doc_id, r.digest) for r in coded}
