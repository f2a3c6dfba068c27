"""The CSV scan maps by header name and fails on what it cannot read."""
import pytest

from ledgerscope.schema import GENERIC_NAMES, TARGET
from ledgerscope.sources.tables import read_credit_csv


def _file(folder, text):
    path = folder / "a.csv"
    path.write_text(text)
    return str(path)


def test_columns_map_by_name_in_any_order(spark, tmp_path):
    df = read_credit_csv(spark, _file(tmp_path, "AGE,LIMIT_BAL,default.payment.next.month,note,PAY_0\n"
                                                "24,1.5,1,a,-1\n25.0,NaN,0,b,\n"))
    assert dict(df.dtypes) == {"AGE": "int", "LIMIT_BAL": "double", TARGET: "int", "note": "string", "PAY_0": "int"}
    assert [tuple(r) for r in df.orderBy("AGE").collect()] == [(24, 1.5, 1, "a", -1), (25, None, 0, "b", None)]


def test_generic_header_is_remapped(spark, tmp_path):
    df = read_credit_csv(spark, _file(tmp_path, "X5,X1,Y\n30,100,1\n"))
    assert df.columns == [GENERIC_NAMES["X5"], GENERIC_NAMES["X1"], GENERIC_NAMES["Y"]]
    assert tuple(df.first()) == (30, 100.0, 1)


@pytest.mark.parametrize("row", ["24,abc", "2.5,1", "24,1,9"])
def test_unreadable_rows_are_errors(spark, tmp_path, row):
    with pytest.raises(Exception):
        read_credit_csv(spark, _file(tmp_path, f"AGE,LIMIT_BAL\n{row}\n")).collect()
