"""Rows of different texts that share an id."""

from collections import Counter

from test_simhash import brute_print

from jobweave.llm import simhash

A = "the quick brown fox jumps over a lazy dog near the old river bank"
B = "seven pale ships carried salt and iron through cold northern waters"


def kept(llm, rows):
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    return Counter((r["doc_id"], r["text"]) for r in simhash.one_of_each(frame).collect())


def test_every_component_keeps_its_own_text(llm):
    assert (brute_print(A) ^ brute_print(B)).bit_count() > simhash.RADIUS
    assert kept(llm, [(5, A), (5, B)]) == Counter([(5, A), (5, B)])
    assert kept(llm, [(5, A), (5, B), (5, B), (6, A), (7, None)]) == Counter([(5, A), (5, B), (7, None)])


def test_a_copy_does_not_pass_with_a_shared_id(llm):
    assert kept(llm, [(3, B.upper()), (5, A), (5, B)]) == Counter([(3, B.upper()), (5, A)])
