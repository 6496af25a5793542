"""The splittable CSV reader against a whole-file parser, at many split sizes."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from marquee.sinks.files import write_csv
from marquee.sources.quoted_csv import INSIDE, KEEP, OUTSIDE, TURN, after, line_effect, read_rows, then
from marquee.sources.restrictions import read_restrictions_csv
from tests.test_sources_sinks import HEADER


@pytest.fixture()
def split_size(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


LINES = ["a,b,c", "", 'a,"b",c', 'a,"b', 'b",c', 'b",c,"d', '5" disc,x', 'say ""hi"" there', 'a,"x""y', '"', '""', '"",""', ',"',
         'x"",y', '"a"tail"more,b', '","', 'a,"b ""c"" d",e', '"""', 'a,""', '"x"",', ',,"",","']


@pytest.mark.parametrize("line", LINES)
def test_effect_of_a_line(spark, line):
    def end(text, inside):
        """The state after a line, one character at a time."""
        state = "in" if inside else "start"
        k = 0
        while k < len(text):
            c = text[k]
            if state == "in":
                if c == '"' and text[k + 1:k + 2] == '"':
                    k += 1
                elif c == '"':
                    state = "rest"
            elif c == ",":
                state = "start"
            elif state == "start" and c == '"':
                state = "in"
            else:
                state = "rest"
            k += 1
        return state == "in"

    want = {(False, False): OUTSIDE, (True, True): INSIDE, (False, True): KEEP, (True, False): TURN}[end(line, False), end(line, True)]
    got = spark.createDataFrame([(line,)], "line string").select(line_effect(F.col("line"), ",", '"')).first()[0]
    assert got == want


def test_effects_chain(spark):
    pairs = spark.createDataFrame([(s, a, b) for s in (0, 1) for a in range(4) for b in range(4)], "s int, a int, b int")
    both = pairs.select(after(after(F.col("s"), F.col("a")), F.col("b")).alias("x"), after(F.col("s"), then(F.col("a"), F.col("b"))).alias("y"))
    assert all(r.x == r.y for r in both.collect())


def rows_of(spark, path):
    found = read_restrictions_csv(spark, path).collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: tuple(r.ord))]


def messy(n, seed):
    rng = random.Random(seed)
    bits = ["palabra", "dos\nlíneas", '"', '""', ",", "\n", "\n\n", " ", "\r\n", "fin", "x" * 40]
    return [(str(k), rng.choice(["TE", "14", 'a,b', 'p"q']), "".join(rng.choice(bits) for _ in range(rng.randrange(9))) or "z",
             rng.choice(["SI", "NO"])) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", ["128m", "900", "61"])
def test_rows_are_those_of_a_whole_file_parser(spark, tmp_dir, split_size, seed, size):
    rows = messy(160, seed)
    path = os.path.join(tmp_dir, "messy.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(HEADER)
        csv.writer(f, lineterminator="\n").writerows(rows)
    split_size(size)
    assert rows_of(spark, path) == [tuple(r) for r in rows]


def test_one_cell_over_many_splits_and_files_apart(spark, tmp_dir, split_size):
    long = "\n".join(f"línea {k}, con \"\"comillas\"\"" for k in range(300))
    for name in ("a.csv", "b.csv"):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(HEADER + f'1,TE,"{long}",NO\n2,14,{name},SI\n3,18,"x\ny",NO\n')
    split_size("500")
    found = rows_of(spark, tmp_dir)
    assert [r[0] for r in found] == ["1", "2", "3"] * 2 and [r[2] for r in found if r[0] == "2"] == ["a.csv", "b.csv"]
    assert found[0][2] == long.replace('""', '"') and found[2][2] == "x\ny"


def test_line_ends_blank_lines_a_mark_and_an_open_cell(spark, tmp_dir):
    path = os.path.join(tmp_dir, "odd.csv")
    with open(path, "wb") as f:
        f.write(("﻿" + HEADER.replace("\n", "\r\n") + '\r\n1,TE,"a\r\nb",NO\r\n\r\n2,14,5" disc,SI\r\n3,18,"never closed\nto the end').encode())
    assert rows_of(spark, path) == [("1", "TE", "a\r\nb", "NO"), ("2", "14", '5" disc', "SI"), ("3", "18", "never closed\nto the end", None)]


def test_a_wrong_header_is_an_error_and_a_header_alone_no_rows(spark, tmp_dir):
    for name, text in (("bad", "id,b,c,d\n1,2,3,4\n"), ("none", HEADER)):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    with pytest.raises(Exception, match="header"):
        rows_of(spark, os.path.join(tmp_dir, "bad"))
    assert rows_of(spark, os.path.join(tmp_dir, "none")) == []


def test_other_encodings_and_separators(spark, tmp_dir):
    path = os.path.join(tmp_dir, "latin.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write(HEADER.replace(",", ";") + '1;TE;"año\ndos";NO\n')
    found = read_restrictions_csv(spark, path, sep=";", encoding="ISO-8859-1").collect()
    assert [tuple(r)[1:] for r in found] == [("1", "TE", "año\ndos", "NO")]
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER.replace(",", ";") + '1;TE;"año, ""dos""\ntres";NO\n')
    assert [tuple(r)[1:] for r in read_restrictions_csv(spark, path, sep=";").collect()] == [("1", "TE", 'año, "dos"\ntres', "NO")]


def test_write_and_read_back(spark, tmp_dir):
    rows = messy(200, 5)
    frame = spark.createDataFrame(rows, "id_pelicula string, clasificacion_chile string, advertencia_contenido string, "
                                        "bloqueo_horario_infantil string").repartition(4)
    found = rows_of(spark, write_csv(frame, os.path.join(tmp_dir, "out")))
    assert sorted(found) == sorted(tuple(r) for r in rows)


def test_a_quiet_file_is_read_without_a_shuffle_of_its_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "quiet.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(f"{k},TE,plain,NO\n" for k in range(2000)))
    plan = read_rows(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
