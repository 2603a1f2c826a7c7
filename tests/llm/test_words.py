"""The word kernel."""

import numpy as np
import pytest

from tessera.llm.common import Words, word_hash


def thue_morse(n: int, letters: str) -> str:
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [32, 33, 512, 1024, 2048, 4096, 8192])
def test_words_that_a_polynomial_cannot_tell_apart(n):
    words = [thue_morse(n, "ab"), thue_morse(n, "ba"), thue_morse(n, "az"), thue_morse(n, "za")]
    assert len({word_hash(w) for w in words}) == 4


def test_long_words_fold_case_and_stand_anywhere():
    long = thue_morse(1024, "ab")
    found = Words([f"x {long.upper()} {long}y".encode(), f"{long}\t{long}y".encode()])
    assert found.count.tolist() == [3, 2]
    assert np.array_equal(found.hash[1:3], found.hash[3:])
    apart = Words([f"{long.upper()} {long}".encode()], "apart").hash
    assert apart[0] != apart[1]
