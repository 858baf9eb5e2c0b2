"""Line breaks inside quotes, cut by many tasks: the same rows as one task per file."""

from __future__ import annotations

import random

import pytest

from veritill.sources import files, quoted_csv

HEADER = ["a", "b x", 'c"d']


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _field(draw):
    text = "".join(draw.choice(["x", "yz", ",", "\n", '"', " ", "ü", "\r\n", ""]) for _ in range(draw.choice([0, 1, 3, 8, 200])))
    if draw.random() < 0.25:  # quotes inside of a field that does not start with one are ordinary
        return 'in"ch' if draw.random() < 0.5 else "plain"
    if text == "" or draw.random() < 0.5 or any(c in text for c in ',\n"\r') or text != text.strip():
        return '"' + text.replace('"', '""') + '"'
    return text


def _file(seed, rows, end="\n"):
    draw = random.Random(seed)
    lines = [",".join('"' + h.replace('"', '""') + '"' for h in HEADER)]
    lines += [",".join(_field(draw) for _ in HEADER) for _ in range(rows)]
    for at in range(5, len(lines), 17):
        lines[at] += end  # an empty line
    return end.join(lines) + (end if draw.random() < 0.5 else "")


def _whole(spark, path):
    """One task per file, in the order of the file."""
    read = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True)
    return [tuple(r) for r in read.csv(path).collect()]


def _split(spark, path):
    found = files.read_csv(spark, path, multiline=True, as_delivered=True)
    rows = found.orderBy("_row_id").collect()
    return [tuple(r)[:-1] for r in rows], {(r["_row_id"]["file"], r["_row_id"]["block"]) for r in rows}


@pytest.mark.parametrize("seed, end, most", [(1, "\n", 50_000), (2, "\n", 50_000), (3, "\r\n", 50_000), (4, "\n", 0)])
def test_one_file_by_many_tasks(spark, tmp_path, small_blocks, monkeypatch, seed, end, most):
    monkeypatch.setattr(quoted_csv, "MOST_BLOCKS", most)
    path = tmp_path / "x.csv"
    path.write_bytes(_file(seed, 120, end).encode())
    found, blocks = _split(spark, str(path))
    assert found == _whole(spark, str(path)) and len(found) == 120
    assert len(blocks) > 5


def test_a_record_over_many_blocks_and_an_open_quote(spark, tmp_path, small_blocks):
    long = "line\n" * 400
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{long}"\n2,z\n3,"never closed\n' + "w\n" * 300)
    found, _ = _split(spark, str(tmp_path / "x.csv"))
    assert found[:2] == [("1", long), ("2", "z")] and len(found) == 3 and found[2][0] == "3"
    assert found[2][1].startswith("never closed\nw\n") or found[2][1].startswith('"never closed\nw\n')


def test_several_files_and_wrong_headers(spark, tmp_path, small_blocks):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "2.csv").write_text('a,b\n"2\n2",z\n\n')
    (folder / "3.csv").write_text("a,b\n")
    found, _ = _split(spark, str(folder))
    assert found == [("1", "x\ny"), ("2\n2", "z")]
    (folder / "4.csv").write_text("a,c\n3,3\n")
    with pytest.raises(Exception, match="header"):
        _split(spark, str(folder))


@pytest.mark.parametrize("seed", range(40))
def test_states_of_lines(seed):
    """Against a walk over the characters."""
    draw = random.Random(seed)
    line = "".join(draw.choice('a",') for _ in range(draw.randint(0, 14)))
    for inside in (False, True):
        state = "quoted" if inside else "start"
        at = 0
        while at < len(line):
            c = line[at]
            if state == "start":
                state = "quoted" if c == '"' else "start" if c == "," else "plain"
            elif state == "plain":
                state = "start" if c == "," else "plain"
            elif c == '"':
                if line[at + 1:at + 2] == '"':
                    at += 1
                else:
                    state = "plain"
            at += 1
        assert quoted_csv._after(line, inside) == (state == "quoted"), (line, inside)
