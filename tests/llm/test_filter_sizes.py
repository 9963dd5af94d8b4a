"""The filters over all tokens and grams follow the corpus, and where they hold some tokens only the links stay the same."""

import pytest

from quern.llm import common, jaccard_join, suffix_dedup
from tests.llm.test_operators import docs, linked_components, plain, texts  # noqa: F401


def test_filters_follow_the_corpus():
    half, six = 864_000_000, 10_200_000_000
    for size in (lambda n: jaccard_join.sizes(n)[0] * jaccard_join.sizes(n)[1], suffix_dedup.filter_size):
        assert size(half) >= half / 5 and size(six) >= six / 5
    assert jaccard_join.sizes(six)[0] <= 1 << 30 and suffix_dedup.filter_size(10**12) == 1 << 31
    assert common.power_above(0) == 1 << 12 and common.power_above(4097) == 1 << 13


@pytest.mark.parametrize("every", [None, 4])
def test_links_with_a_share_of_the_tokens(docs, plain, monkeypatch, every):  # noqa: F811
    if every:
        monkeypatch.setattr(jaccard_join, "sizes", lambda n: (1 << 12, every, 6))
    out = jaccard_join.jaccard_components(docs, size=4, percent=85)
    assert sorted(map(tuple, out.collect()), key=str) == linked_components(plain, 4, 85)
