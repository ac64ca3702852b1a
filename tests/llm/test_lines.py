"""Line hashing and cutting: slices do not matter, and what stays whole is passed on as it is."""

import pyarrow as pa

from orderlore.llm import lines


def _batch(texts, removed):
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), pa.array(removed, pa.list_(pa.int32()))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "removed"])


def test_cut_texts_and_counts():
    texts = ["a\nb\na", None, "", "one", "x\n", "gone", "é\n😀\né"]
    removed = [[2], None, None, [], None, [0], [0, 2]]
    (out,) = lines._cut(iter([_batch(texts, removed)]))
    assert out.column("text").to_pylist() == ["a\nb", None, "", "one", "x\n", "", "😀"]
    assert out.column("n_lines").to_pylist() == [3, 0, 0, 1, 2, 1, 3]
    assert out.column("n_removed").to_pylist() == [1, 0, 0, 0, 0, 1, 2]


def test_whole_texts_are_not_copied():
    batch = _batch(["a\nb", None, "c"], [None, None, []])
    (out,) = lines._cut(iter([batch]))
    assert out.column("text").buffers()[2].address == batch.column("text").buffers()[2].address


def test_plain_lines_of_odd_texts():
    points, begins, text, number = lines._plain(["", "A b\n\n@Z[", "`\t{\x7f\x80É", "\n"])
    told = ["".join(map(chr, points[a:b])) for a, b in zip(begins[:-1], begins[1:])]
    assert told == ["", "ab", "", "@z[", "`{\x7f\x80É", "", ""]
    assert text.tolist() == [0, 1, 1, 1, 2, 3, 3] and number.tolist() == [0, 0, 1, 2, 0, 0, 1]
