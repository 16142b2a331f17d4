"""Words of whole batches: the same as of one text at a time, and nothing put aside for them."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from pairlab.llm import bpe, decontaminate, quality
from pairlab.llm.words import Recent, claim, split_words

TEXTS = ["", "a a  B.\n\n5 km to Paris. New\x1cwords", " \n ", "!! ?? -", "x", "B. 6 km from Berlin, they said: 7 lbs", "é　漢 字_"]


def test_words_of_a_batch_are_those_of_each_text():
    words, offsets = split_words(pa.array(TEXTS))
    found = words.to_pylist()
    assert [found[a:b] for a, b in zip(offsets, offsets[1:])] == [t.split() for t in TEXTS]


def test_windows_of_a_batch_are_those_of_each_text():
    words, offsets, values, kinds = decontaminate.template(pa.array(TEXTS))
    whole = {w: (h, g) for w, h, g, _ in decontaminate.windows(offsets, values, kinds, [1, 2, 4])}
    counted = dict.fromkeys(whole, 0)
    for k, text in enumerate(TEXTS):
        own = decontaminate.template(pa.array([text]))
        assert own[0].to_pylist() == words.to_pylist()[offsets[k]:offsets[k + 1]]
        for width, hashes, good, _ in decontaminate.windows(*own[1:], [1, 2, 4]):
            at = slice(offsets[k], offsets[k + 1] - width + 1)
            assert (whole[width][0][:, at] == hashes).all() and (whole[width][1][:, at] == good).all()
            counted[width] += good.sum()
    assert counted == {w: g.sum() for w, (_, g) in whole.items()}


def test_quality_of_a_batch_is_that_of_each_text():
    vectors = np.random.default_rng(1).normal(size=(quality.WORD_BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    whole = quality.pooled(pa.array(TEXTS), vectors)
    assert (whole == np.concatenate([quality.pooled(pa.array([t]), vectors) for t in TEXTS])).all()


def test_what_workers_put_aside_is_small():
    """An executor's workers keep this from stage to stage beside the JVM's heap."""
    codec = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    claim(codec.words)
    many = pa.array([" ".join(f"w{k}x{k * 7}" for k in range(5000))])
    before = len(list(codec.encode_all(many)))
    decontaminate.template(many)
    quality.tokens(many)
    kept = [c for reference in Recent.made if (c := reference()) is not None and (c or c.before)]
    assert before == 1 and len(kept) == 1 and kept[0] is codec.words
    assert all(type(ids) is bytes and len(ids) < 64 for ids in kept[0].values()) and kept[0].limit <= 300_000
