"""Links of blocks as one packed value."""

import numpy as np
import pytest

from areapanel.llm import alignment

public = pytest.importorskip("public_tokenizers")
FILES = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def test_links_leave_a_task_packed(spark):
    docs = spark.createDataFrame([(i, "the model of the words of the model " * 200) for i in range(50)], "doc_id long, text string")
    blocks = alignment.aligned_blocks(docs.coalesce(1), *FILES)
    assert dict(blocks.dtypes)["links"] == "binary"
    got = blocks.collect()
    assert sum(len(r.links) for r in got) * 4 < sum(sum(r.n_links) for r in got)
    for r in got:
        places = alignment._unpacked(r.links, sum(r.n_links))
        assert np.bincount(places, minlength=len(r.pairs)).tolist() == r.counts


@pytest.mark.parametrize("places", [[], [0], [65535, 0], [65536, 3, 65536]])
def test_packed_numbers(places):
    assert alignment._unpacked(alignment._packed(np.array(places, np.int64)), len(places)).tolist() == places
