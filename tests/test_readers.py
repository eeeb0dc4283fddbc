"""Raw files with reordered headers, broken records and quoted line breaks beside pandas."""

import io

import pandas as pd
import pytest

from forecourt.sources.readers import scan_audit, scan_listings, scan_records
from forecourt.sources.storage import scratch

COLUMNS = ("brand", "model", "year", "note")


def folder(spark, tmp_path_factory, **files):
    path = tmp_path_factory.mktemp("raw")
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    return str(path)


def as_pandas(text):
    df = pd.read_csv(io.StringIO(text), dtype=str)
    return [tuple(None if isinstance(v, float) else v for v in row) for row in df[list(COLUMNS)].itertuples(index=False)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns_go_by_the_header_of_each_file(spark, tmp_path_factory):
    texts = {"a": "brand,model,year,note\naudi,A1,2010,x\n", "b": "note,year,extra,model,brand\ny,2011,?,M3,bmw\nz,2012,?,M4,bmw\n",
             "c": "﻿year,brand,note,model\n2013,vw,,Golf\n", "empty": "", "none": "brand,model,year,note\n"}
    path = folder(spark, tmp_path_factory, **texts)
    wanted = [r for k in "ab" for r in as_pandas(texts[k])] + as_pandas(texts["c"].removeprefix("﻿"))
    assert rows(scan_listings(spark, path, COLUMNS)) == sorted(wanted, key=str)


def test_quoted_breaks_separators_and_quotes(spark, tmp_path_factory):
    text = 'brand,model,year,note\naudi,"A1, new",2010,"two\nlines, and ""three""\n\nmore"\nbmw,M3,2011,"a ""b"""\n\nvw,"",NA,last\n'
    found = scan_records(spark, folder(spark, tmp_path_factory, a=text, b="note,brand,model,year\nplain,vw,Polo,2001\n"), COLUMNS)
    assert rows(found.kept) == sorted([*as_pandas(text), ("vw", "Polo", "2001", "plain")], key=str)
    assert found.quarantined.count() == 0


def test_broken_records_are_set_aside(spark, tmp_path_factory):
    good = "brand,model,year,note\naudi,A1,2010\nbmw,M3\nvw,Golf,2012,ok\n"
    bad = good + 'seat,Ibiza,2013,one,two\nfiat,"Panda, red",2014,"x,y",z\n'
    found = scan_records(spark, folder(spark, tmp_path_factory, a=bad), COLUMNS)
    # pandas fills short records and refuses the file for the long ones.
    assert rows(found.kept) == sorted(as_pandas(good), key=str)
    with pytest.raises(pd.errors.ParserError):
        pd.read_csv(io.StringIO(bad))
    aside = sorted((r.reason, r.raw) for r in found.quarantined.collect())
    assert aside == [("too many fields", 'fiat,"Panda, red",2014,"x,y",z'), ("too many fields", "seat,Ibiza,2013,one,two")]
    assert all(r.file.endswith("a.csv") for r in found.quarantined.collect())
    audit = {r.reason: (r.records, r.read) for r in scan_audit(found).collect()}
    assert audit == {"kept": (3, 5), "too many fields": (2, 5)}
    assert found.kept.select("year").count() == 3 and found.quarantined.select("raw").count() == 2  # whatever is asked for


def test_a_quote_that_is_never_closed(spark, tmp_path_factory):
    found = scan_records(spark, folder(spark, tmp_path_factory, a='brand,model,year,note\naudi,A1,2010,x\nbmw,"M3,2011,y\nvw,Golf,2012,z\n'), COLUMNS)
    assert rows(found.kept) == [("audi", "A1", "2010", "x")]
    assert [r.reason for r in found.quarantined.collect()] == ["unclosed quote"]


def test_headers_that_do_not_fit(spark, tmp_path_factory):
    with pytest.raises(ValueError, match="missing .'note'."):
        scan_records(spark, folder(spark, tmp_path_factory, a="brand,model,year\na,b,1\n"), COLUMNS)
    with pytest.raises(ValueError, match="repeated .'brand'."):
        scan_records(spark, folder(spark, tmp_path_factory, a="brand,model,year,note,brand\na,b,1,c,d\n"), COLUMNS)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan_listings(spark, scratch(spark, "nothing"), COLUMNS)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_with_quoted_breaks_are_split(spark, tmp_path_factory, end):
    """Splits of a few bytes begin anywhere: inside quotes, in lines that settle nothing, in the header."""
    notes = ["plain", '"two\nlines"', '"a ""b""\n"" c"', '"\n\n"', '""', '"x, ""y"",\n1,2\n"', 'inch 5" wide', '"""\n"', '" late"']
    lines = ["", "brand,model,year,note", ""]
    for i in range(60):
        lines.append(f"b{i},{notes[i % 9]},{2000 + i % 20},{notes[i * 7 % 11 % 9]}")
        if i % 10 == 3:
            lines += ["", f'c{i},"M\n{i}",2001,one,"two\n, three"', f"d{i}"]
    text = end.join(line.replace("\n", end) for line in lines) + end
    path = folder(spark, tmp_path_factory, a=text, b=text.replace("b1", "e1"))
    whole = spark.read.schema("a string, b string, c string, d string, r string").csv(
        path, header=True, enforceSchema=True, multiLine=True, escape='"', columnNameOfCorruptRecord="r", mode="PERMISSIVE").cache()
    # Short records are kept.
    wanted = sorted(((r.a, r.b, r.c, r.d) for r in whole.collect() if not (r.r and r.a.startswith("c"))), key=str)
    aside = sorted(r.r for r in whole.collect() if r.r and r.a.startswith("c"))
    for size in ("29", "300", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = scan_records(spark, path, COLUMNS)
            assert "FileScan csv" not in found.kept._jdf.queryExecution().toString()  # that one reads a file in one task
            assert rows(found.kept) == wanted, size
            assert sorted(r.raw for r in found.quarantined.collect()) == aside, size
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
