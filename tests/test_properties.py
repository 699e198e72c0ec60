"""Properties of the split sizes over many class tables."""

import math

from hypothesis import given
from hypothesis import strategies as st

from plumbline.operators.split import quotas


@given(
    st.lists(st.integers(2, 10**13), min_size=1, max_size=40),
    st.floats(0.01, 0.99),
)
def test_quotas_are_exact_and_fair(sizes, share):
    counts = list(enumerate(sizes))
    total = sum(sizes)
    want = math.ceil(share * total)
    got = quotas(counts, share)
    assert [c for c, _ in got] == [c for c, _ in counts]
    assert sum(n for _, n in got) == want
    for (_, n), (_, size) in zip(got, counts, strict=True):
        # Within one row of the exact share, in whole numbers.
        assert abs(n * total - want * size) < total
        assert 0 <= n <= size
