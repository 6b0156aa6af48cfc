from martloom.llm.pieces import MOST_IDS, ROWS, DoubleArray


def test_tables_of_a_task_are_small():
    trie = DoubleArray({"a": 0, "ab": 1, "b": 2})
    assert {x.itemsize for x in (trie.base, trie.check, trie.value)} == {4}
    assert ROWS <= 256 and MOST_IDS <= 1_000_000
