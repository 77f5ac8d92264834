"""A checkpoint of answers: resumed, refused, cut off."""

import pytest

from geoweave.operators import classify
from geoweave.plans import answers

SCHEMA = "polygon_id string, row_index long, sentences_with_topic_term array<string>"
HEADER = {"source": "abc", "model": "stub", "prompt_sha256": classify.prompt_hash("Is it? {}")}


def frame(spark, n=40):
    return spark.createDataFrame([(f"w/{i % 3}", i, [f"s{i}", "x" * i][: 1 + i % 2]) for i in range(n)], SCHEMA).repartition(3)


def even(texts):
    return ["yes" if len(t) % 2 == 0 else "no" for t in texts]


def refuse(texts):
    raise OSError("the model is lost")


def plain(rows):
    return sorted(map(str, rows.select("polygon_id", "row_index", "labels").collect()))


def files(path, wave):
    return sorted(p for p in (path / "answers" / f"wave={wave}").iterdir() if p.name.startswith("part-") and p.stat().st_size)


def test_answers_are_kept_and_only_new_rows_are_asked(spark, tmp_path):
    path, rows = str(tmp_path / "c"), frame(spark)
    want = plain(classify.labelled(rows, even))
    assert plain(answers.answered(rows.where("row_index < 25"), even, path, HEADER, wave_rows=10)) == plain(classify.labelled(rows.where("row_index < 25"), even))
    with pytest.raises(Exception, match="the model is lost"):
        answers.answered(rows, refuse, path, HEADER)
    assert plain(answers.answered(rows, even, path, HEADER)) == want
    assert plain(answers.answered(rows, refuse, path, HEADER)) == want  # nothing is left to ask


def test_a_lost_run_keeps_its_whole_waves(spark, tmp_path):
    path, rows = str(tmp_path / "c"), frame(spark)
    marker = tmp_path / "asked"

    def until(texts):
        with open(marker, "a") as f:
            f.write("x" * len(texts))
        if marker.stat().st_size > 25:
            raise OSError("lost")
        return even(texts)

    with pytest.raises(Exception, match="lost"):
        answers.answered(rows, until, path, HEADER, wave_rows=10)
    known, number = answers.read_answers(spark, path, "polygon_id string, row_index long", ["polygon_id", "row_index"])
    assert 0 < known.count() < 40 and number >= 1
    assert plain(answers.answered(rows, even, path, HEADER)) == plain(classify.labelled(rows, even))


def test_other_headers_are_refused(spark, tmp_path):
    path, rows = str(tmp_path / "c"), frame(spark, 4)
    answers.answered(rows, even, path, HEADER)
    for other in (HEADER | {"model": "new"}, HEADER | {"prompt_sha256": classify.prompt_hash("Was it? {}")}, {}):
        with pytest.raises(ValueError, match="does not match"):
            answers.answered(rows, even, path, other)


def test_a_cut_line_of_the_last_wave_is_asked_again_and_others_are_errors(spark, tmp_path):
    path, rows = tmp_path / "c", frame(spark)
    answers.answered(rows, even, str(path), HEADER, wave_rows=20)
    last = files(path, 1)[-1]
    text = last.read_text()
    last.write_text(text[:-12])
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    asked = []
    assert plain(answers.answered(rows, even, str(path), HEADER)) == plain(classify.labelled(rows, even)) and not asked
    first = files(path, 0)[0]
    first.write_text(first.read_text()[:-12])
    (first.parent / f".{first.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="no answers"):
        answers.answered(rows, even, str(path), HEADER)


@pytest.mark.parametrize("line", ['{"polygon_id":"w/0","row_index":0,"labels":["maybe"]}', '{"polygon_id":"w/0","labels":["yes"]}', '{"polygon_id":"w/0","row_index":0}', "[1]"])
def test_lines_that_are_no_answers(spark, tmp_path, line):
    path = tmp_path / "c"
    answers.open_checkpoint(spark, str(path), HEADER | {"key": ["polygon_id", "row_index"]})
    (path / "answers" / "wave=0").mkdir(parents=True)
    (path / "answers" / "wave=0" / "part-0.txt").write_text(f"\n{line}\n")
    with pytest.raises(ValueError, match="no answers"):
        answers.answered(frame(spark, 3), even, str(path), HEADER)


def test_repeated_rows_are_refused(spark, tmp_path):
    path = tmp_path / "c"
    answers.answered(frame(spark, 3), even, str(path), HEADER)
    (path / "answers" / "wave=7").mkdir()
    (path / "answers" / "wave=7" / "part-0.txt").write_text(files(path, 0)[0].read_text())
    with pytest.raises(ValueError, match="repeats"):
        answers.answered(frame(spark, 3), even, str(path), HEADER)
    assert answers.read_answers is not None


def test_no_rows(spark, tmp_path):
    assert answers.answered(frame(spark, 3).limit(0), refuse, str(tmp_path / "c"), HEADER).count() == 0
