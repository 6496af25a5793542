"""Randomised checks of the text expressions against Python's string semantics.

The cleaning reproduces Python string behaviour (strip of Unicode blanks,
blank-run collapse, title case of all-capital titles). Each test generates a
few thousand strings and compares them in one Spark job.
"""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from marquee.functions import clean_title, parse_date, strip_blanks, to_int_id
from marquee.functions.text import BLANK_CHARS

ALPHABET = ("abcXYZ éÉàÀñÑßǄǅǆ' -.,/0123456789" + BLANK_CHARS)


def _strings(n, seed, alphabet=ALPHABET, max_len=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


def _py_clean_title(s):
    t = re.sub(r"\s+", " ", s.strip())
    if t == "":
        return None
    return t.title() if t.isupper() else t


def test_strip_matches_python(spark):
    data = _strings(3000, 1)
    df = spark.createDataFrame([(s,) for s in data], "t string")
    got = [r[0] for r in df.select(strip_blanks("t")).collect()]
    assert got == [s.strip() for s in data]


def test_clean_title_matches_python(spark):
    data = _strings(3000, 2) + [s.upper() for s in _strings(3000, 3)]
    df = spark.createDataFrame([(s,) for s in data], "t string")
    got = [r[0] for r in df.select(clean_title("t")).collect()]
    want = [_py_clean_title(s) for s in data]
    bad = [(d, g, w) for d, g, w in zip(data, got, want) if g != w]
    assert not bad, bad[:5]


def test_int_ids_match_python_parse(spark):
    data = _strings(3000, 4, alphabet="0123456789 +-.eE x", max_len=8)
    df = spark.createDataFrame([(s,) for s in data], "t string")
    got = [r[0] for r in df.select(to_int_id(F.col("t"))).collect()]

    def py(s):
        t = s.strip()
        if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", t):
            return None
        try:
            return int(t)
        except ValueError:
            v = float(t)
            return int(v) if abs(v) < 2 ** 63 else None
    assert got == [py(s) for s in data]


def test_dates_match_python_calendar(spark):
    rng = random.Random(5)

    def field(lo, hi):
        v = rng.randint(lo, hi)
        return f"{v:02d}" if rng.random() < 0.5 else str(v)

    data = []
    for _ in range(3000):
        y, m, d = str(rng.randint(1000, 2999)), field(0, 14), field(0, 33)
        data.append(f"{y}-{m}-{d}" if rng.random() < 0.5 else f"{d}/{m}/{y}")
    data += ["00/00/0000", "29/02/2024", "29/02/2023", "31/04/2024", "2024-02-30", " 1/1/2020 "]
    df = spark.createDataFrame([(s,) for s in data], "t string")
    got = [r[0] for r in df.select(parse_date("t")).collect()]

    def py(s):
        t = s.strip()
        for pattern, order in ((r"(\d{4})-(\d{1,2})-(\d{1,2})", (0, 1, 2)),
                               (r"(\d{1,2})/(\d{1,2})/(\d{4})", (2, 1, 0))):
            m = re.fullmatch(pattern, t)
            if m:
                parts = [int(x) for x in m.groups()]
                try:
                    return dt.date(*(parts[i] for i in order))
                except ValueError:
                    return None
        return None
    bad = [(x, g, py(x)) for x, g in zip(data, got) if g != py(x)]
    assert not bad, bad[:5]
