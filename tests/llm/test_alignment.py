from hypothesis import given, settings
from hypothesis import strategies as st

from venuekit.llm.alignment import banded_distance, within


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        up = [i]
        for j, y in enumerate(b, 1):
            up.append(min(row[j] + 1, up[-1] + 1, row[j - 1] + (x != y)))
        row = up
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=30), st.text("abc", max_size=30), st.integers(0, 12))
def test_distance_is_exact_within_the_limit(a, b, limit):
    wanted = min(plain(a, b), limit + 1)
    assert banded_distance(a, b, limit) == wanted
    assert within(a, b, limit) == wanted


def test_lists_of_words_and_long_inputs():
    a = [f"w{i % 97}" for i in range(3000)]
    b = [*a[:1000], "new", *a[1000:2500], *a[2510:]]
    assert within(a, b, 600) == 11
    assert within(a, a, 0) == 0 and within(a, b, 5) == 6
    assert banded_distance("", "abc", 2) == 3 and banded_distance("", "", 0) == 0
