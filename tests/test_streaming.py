from tilescan.sources import files
from tilescan.streaming import detections

HEAD = "filename,bbox,confidence\n"


def test_envelopes_grow_with_arriving_files(spark, tmp_path):
    into, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    into.mkdir()
    (into / "1.csv").write_text(HEAD + 'a,"[1 2 3 4]",0.5\na,0 0 9 9,0.25\nb,1 2 3,0.9\n')
    run = lambda: detections.keep_as_table(detections.envelopes(detections.arriving(spark, str(into))), out, mark).awaitTermination()
    run()
    assert [tuple(r) for r in detections.latest(spark, out).collect()] == [("a", 1.0, 2.0, 3.0, 4.0, 0.5, 1)]
    (into / "2.csv").write_text(HEAD + "a,0 2.5 2 5,1.0\nc,1 1 2 2,0.75\n")
    (into / "3.csv").write_text(HEAD)
    run()
    got = sorted(tuple(r) for r in detections.latest(spark, out).collect())
    assert got == [("a", 0.0, 2.0, 3.0, 5.0, 0.75, 2), ("c", 1.0, 1.0, 2.0, 2.0, 0.75, 1)]
    whole = detections.envelopes(files.read_detections(spark, str(into)))
    assert got == sorted(tuple(r) for r in whole.collect())
