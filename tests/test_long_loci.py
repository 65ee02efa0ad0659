import random

import pytest
from test_loci import mutated

from seqloom.operators import kernels as ke
from seqloom.operators import loci


def test_long_loci_are_aligned(spark):
    """No length sets a locus aside, and a few long sequences are aligned in a table that is kept in part."""
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(6000))
    rows = [(1, 0, base), (1, 1, mutated(rng, base)), (2, 0, "A" * 5001), (2, 1, "A"), (3, 0, "ACGT")]
    got = loci.aligned_loci(spark.createDataFrame(rows, "id long, row long, seq string"), 2).collect()
    assert {(r.id, r.row): r.aligned.replace("-", "") for r in got} == {(i, r): s for i, r, s in rows}
    assert {r.status for r in got} == {"ok"}
    assert all(len({len(r.aligned) for r in got if r.id == i}) == 1 for i in (1, 2, 3))


@pytest.mark.parametrize("symbols", ["AC", "ACGT", "Aé-"])
def test_tables_in_part_give_the_same_alignment(monkeypatch, symbols):
    rng = random.Random(9)
    text = lambda: "".join(rng.choice(symbols) for _ in range(rng.randrange(40)))
    pairs = [(text(), text()) for _ in range(300)]
    whole = [ke.align(a, b) for a, b in pairs]
    monkeypatch.setattr(ke, "CELLS", 1)
    assert [ke.align(a, b) for a, b in pairs] == whole
