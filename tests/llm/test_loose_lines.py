"""Line dedup of rows without an id."""

from streamfold.llm import line_dedup
from tests.llm import brute
from tests.llm.test_edges import PASSAGE, loose_orders


def test_lines_without_id(spark):
    said = "\n".join(f"row {i} that rows without any id hold" for i in range(5))
    rows = [(None, t) for t in (None, said, said, f"one\n{said}", f"{said}\nother", f"known\n{PASSAGE}")] + [(3, ""), (6, PASSAGE)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = line_dedup.dedup_lines(df).collect()
    have = ({r.doc_id: r.text for r in got if r.doc_id is not None}, sorted(r.text or "" for r in got if r.doc_id is None))
    assert len(got) == len(rows)
    assert have in loose_orders(rows, brute.lines)


def test_windows_of_rows_without_id_stay_apart(spark):
    rows = [(None, f"{i}\nsame\nlines\nhere\n{i}") for i in range(50)]
    keyed = line_dedup.keyed(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "test_loose")[0]
    later = line_dedup.later_windows(keyed, "text").collect()
    assert len(later) == 49 and {len(r._sf_hs) for r in later} == {32}          # one hash each
