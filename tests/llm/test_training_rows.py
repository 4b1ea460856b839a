"""What the fit of the language model sends to the driver."""

import numpy as np

from budgetloom.llm import language_id


def test_the_fit_gets_a_text_in_few_bytes():
    words = np.random.default_rng(3).choice(["la maison", "the house", "das Haus", "é\U00010348", "una casa", "x"], 3000)
    for text in (" ".join(words), "a", "ß" * 70_000):
        counts = language_id.gram_counts(text)
        at, n = language_id.unpacked(language_id.packed(text))
        assert at.tolist() == np.flatnonzero(counts).tolist() and n.tolist() == counts[at].tolist()
    for text in (None, "", "123 !"):
        assert [len(x) for x in language_id.unpacked(language_id.packed(text))] == [0, 0]
    plain = "".join(chr(97 + i) for i in np.random.default_rng(5).integers(0, 26, 2000))
    assert len(language_id.packed(plain)) < 4 * len(np.flatnonzero(language_id.gram_counts(plain)))  # 8 as arrays of 32 bits
