import random
import time

from seqloom.operators import kernels as ke


def test_many_blocks_in_time():
    """A long alignment of short blocks: a block costs what it holds."""
    rng = random.Random(1)
    rows = ["".join(rng.choice("ACGT-") for _ in range(100)) for _ in range(8000)]
    begun = time.time()
    got = ke.unaligned(rows)
    assert time.time() - begun < 4
    assert all(set(g) <= {"-", *r} for g, r in zip(got, rows, strict=True))


def test_wide_blocks_and_other_symbols(spark):
    """Blocks of over 64 columns, symbols that are no bases, and alignments without a name."""
    rows = [(a, r, s) for a in (None, 0, 5) for r, s in enumerate(["A" * 100 + "-é", "C" * 100 + "Né", "A" * 100 + "--"])]
    df = spark.createDataFrame(rows, "aln long, row long, seq string")
    got = {(r.aln, r.row): r.seq for r in ke.mask_unaligned(df).collect()}
    assert got == {(a, r): s for a in (None, 0, 5) for r, s in enumerate(["-" * 102, "-" * 102, "A" * 100 + "--"])}
