"""Readers, writers and the launcher, down to the bytes."""

from __future__ import annotations

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymonth import (
    AS_IMPLEMENTED,
    AS_SPECIFIED,
    monthly_report,
    read_category_versions,
    read_fee_periods,
    read_merchant_categories,
    read_monthly_files,
    read_plain_csv,
    read_transactions,
    scratch,
    write_month_partitions,
    write_monthly_files,
    write_plain_csv,
)
from tallymonth.__main__ import main
from tallymonth.schemas import REPORT
from tests.helpers import categories_of, plan_of, transactions_of
from tests.model import Category, Transaction

HEADER = (
    "fi_code|date|service_system_type|transaction_type|merchant_business_type|"
    "merchant_category_code|amount|number|terminal_average_amount_range\r\n"
)


def data_files(path) -> list[str]:
    return sorted(name for name in os.listdir(path) if not name.startswith((".", "_")))


def report_of(spark, rows, profile=AS_SPECIFIED):
    return monthly_report(
        transactions_of(spark, rows), categories_of(spark, [Category()]), profile
    )


DECEMBER = Transaction(amount=Decimal("1234567.50"))
NOVEMBER = Transaction(
    date=datetime.date(2018, 11, 5),
    amount=None,
    payment_method="payment02",
    backend_name="b12",
    merchant_category_id=None,
)


def test_monthly_files_byte_by_byte(spark, tmp_path) -> None:
    path = str(tmp_path / "out")
    names = write_monthly_files(report_of(spark, [DECEMBER, NOVEMBER]), path, AS_SPECIFIED)
    assert names == data_files(path) == ["ACME_20181130.csv", "ACME_20181231.csv"]
    assert (tmp_path / "out/ACME_20181231.csv").read_bytes() == (
        HEADER + "42|2018-12-31|CPF|010001|30101|0742|1234567.50|1|94560000007\r\n"
    ).encode()
    assert (tmp_path / "out/ACME_20181130.csv").read_bytes() == (
        HEADER + "42|2018-11-30|OTH|000001||||1|\r\n"
    ).encode()


@pytest.mark.parametrize(
    ("amount", "as_implemented", "as_specified"),
    [
        ("1234567.50", "1234567.5", "1234567.50"),
        ("100.00", "100.0", "100.00"),
        ("0.05", "0.05", "0.05"),
        ("123456789012.10", "123456789012.1", "123456789012.10"),
        ("-7.00", "-7.0", "-7.00"),
    ],
)
def test_amount_text(spark, tmp_path, amount, as_implemented, as_specified) -> None:
    for profile, text in ((AS_IMPLEMENTED, as_implemented), (AS_SPECIFIED, as_specified)):
        rows = [Transaction(amount=Decimal(amount))]
        path = tmp_path / profile.name
        write_monthly_files(report_of(spark, rows, profile), str(path), profile)
        line = (path / "ACME_20181231.csv").read_text().splitlines()[1]
        assert line.split("|")[6] == text


def test_monthly_files_replace_their_own_month_only(spark, tmp_path) -> None:
    path = str(tmp_path)
    write_monthly_files(report_of(spark, [DECEMBER, NOVEMBER]), path)
    november = (tmp_path / "ACME_20181130.csv").read_bytes()
    write_monthly_files(report_of(spark, [Transaction(), Transaction()]), path)
    assert data_files(path) == ["ACME_20181130.csv", "ACME_20181231.csv"]
    assert (tmp_path / "ACME_20181130.csv").read_bytes() == november
    assert read_monthly_files(spark, path).count() == 2
    assert not [name for name in os.listdir(path) if name.startswith("_staging")]


def test_undated_rows_are_kept(spark, tmp_path) -> None:
    names = write_monthly_files(report_of(spark, [DECEMBER, Transaction(date=None)]), str(tmp_path))
    assert names == ["ACME_20181231.csv", "ACME_UNDATED.csv"]
    assert read_monthly_files(spark, str(tmp_path)).count() == 2


def test_record_limit_of_the_session_does_not_split_a_month(spark, tmp_path) -> None:
    rows = [Transaction(card_brand=brand) for brand in ("brand01", "brand02", "brand03", "other")]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    try:
        names = write_monthly_files(report_of(spark, rows), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert names == ["ACME_20181231.csv"]
    assert read_monthly_files(spark, str(tmp_path)).count() == 4


def test_month_partitions_hold_one_file_and_prune(spark, tmp_path) -> None:
    path = str(tmp_path)
    write_month_partitions(report_of(spark, [DECEMBER, NOVEMBER]), path)
    directories = data_files(path)
    assert directories == ["report_file=ACME_20181130", "report_file=ACME_20181231"]
    assert [len(data_files(tmp_path / name)) for name in directories] == [1, 1]

    back = read_monthly_files(spark, path)
    assert back.count() == 2
    one = spark.read.option("sep", "|").option("header", True).csv(path)
    one = one.filter(F.col("report_file") == "ACME_20181130")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(report_file" in plan_of(one)


def test_plain_csv(spark, tmp_path) -> None:
    path = tmp_path / "plain"
    report = report_of(spark, [DECEMBER, NOVEMBER])
    write_plain_csv(report, str(path))
    lines = sorted(
        line
        for name in data_files(path)
        for line in (path / name).read_text().splitlines()
    )
    assert lines == [
        '42,2018-11-30,OTH,000001,"",,,1,',
        "42,2018-12-31,CPF,010001,30101,0742,1234567.50,1,94560000007",
    ]
    assert read_plain_csv(spark, str(path)).count() == 2
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_plain_csv(report, str(path))


TX_HEADER = (
    "note,merchant_category_id,date,amount,payment_method,card_type,card_brand,"
    "card_country_issuer_code,backend_name\n"
)


def test_transactions_are_read_by_name(spark, tmp_path) -> None:
    source = tmp_path / "tx.csv"
    source.write_text(
        TX_HEADER
        + "n,7,2018-12-03,12.50,payment01,type01,brand01,A029,\n"
        + "n,x,2018-12-03,lots,payment01,,brand01,A029,b03\n"
    )
    rows = read_transactions(spark, str(source))
    assert [tuple(row) for row in rows.collect()] == [
        Transaction(amount=Decimal("12.50"), merchant_category_id="7"),
        Transaction(amount=None, card_type=None, backend_name="b03", merchant_category_id="x"),
    ]
    kept = read_transactions(spark, str(source), keep_corrupt_record=True).collect()
    assert [row["_corrupt_record"] for row in kept] == [
        None,
        "n,x,2018-12-03,lots,payment01,,brand01,A029,b03",
    ]


def test_only_used_columns_are_parsed(spark, tmp_path) -> None:
    source = tmp_path / "tx.csv"
    source.write_text(TX_HEADER + "n,7,2018-12-03,12.50,payment01,type01,brand01,A029,\n")
    plan = plan_of(read_transactions(spark, str(source)).select("date", "amount"))
    assert "ReadSchema: struct<date:date,amount:decimal(28,6)>" in plan


def test_amount_type_keeps_fine_amounts(spark, tmp_path) -> None:
    source = tmp_path / "tx.csv"
    source.write_text(TX_HEADER + "n,7,2018-12-03,0.335,payment01,type01,brand01,A029,\n")
    assert read_transactions(spark, str(source)).first()["amount"] == Decimal("0.335")
    coarse = read_transactions(spark, str(source), amount_type=T.DecimalType(18, 2))
    assert coarse.first()["amount"] == Decimal("0.34")


def test_missing_column_is_named(spark, tmp_path) -> None:
    source = tmp_path / "tx.csv"
    source.write_text(TX_HEADER.replace("card_brand", "brand"))
    with pytest.raises(ValueError, match="card_brand"):
        read_transactions(spark, str(source))


def test_files_of_a_directory_must_agree(spark, tmp_path) -> None:
    (tmp_path / "a.csv").write_text("id,code\n1,0742\n")
    (tmp_path / "b.csv").write_text("code,id\n0743,2\n")
    with pytest.raises(Exception, match="header"):
        read_merchant_categories(spark, str(tmp_path)).collect()


def test_category_codes_keep_leading_zeros(spark, tmp_path) -> None:
    source = tmp_path / "mcc.csv"
    source.write_text("id,name,code\n1,shop,0742\n2,shop,\n")
    rows = read_merchant_categories(spark, str(source)).collect()
    assert [tuple(row) for row in rows] == [("1", "0742"), ("2", None)]


@pytest.mark.parametrize("profile", ["as_implemented", "as_specified"])
def test_launcher(spark, tmp_path, capsys, profile) -> None:
    (tmp_path / "mcc.csv").write_text("id,code\n7,0742\n7,0743\n")
    (tmp_path / "tx.csv").write_text(
        TX_HEADER
        + "n,7,2018-12-03,12.50,payment01,type01,brand01,A029,\n"
        + "n,,2018-11-03,5.00,payment02,,,,b12\n"
    )
    inputs = ["--transactions", f"{tmp_path}/tx.csv", "--categories", f"{tmp_path}/mcc.csv"]
    out = ["--output", f"{tmp_path}/out", "--profile", profile]
    assert main([*inputs, *out]) == 3
    said = capsys.readouterr().out
    assert "ids repeat" in said and "Reporting records: 3" in said
    assert data_files(tmp_path / "out") == ["ACME_20181130.csv", "ACME_20181231.csv"]

    plain = ["--output", f"{tmp_path}/plain", "--profile", profile, "--sink", "plain"]
    assert main([*inputs, *plain]) == 3


def test_scratch_directories_are_new_and_shared(spark) -> None:
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (scratch.new_directory(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(f"{base}/x-")


def test_values_are_written_as_they_are(spark, tmp_path) -> None:
    row = ("42", "2018-12-31", "CPF", "010001", ' 3"0 ', " 0742", Decimal("1.00"), 1, "94560000001")
    report = spark.createDataFrame([row], REPORT)
    (name,) = write_monthly_files(report, str(tmp_path), AS_SPECIFIED)
    line = (tmp_path / name).read_bytes().split(b"\r\n")[1]
    assert line == b'42|2018-12-31|CPF|010001|" 3""0 "| 0742|1.00|1|94560000001'
    assert [tuple(r) for r in read_monthly_files(spark, str(tmp_path)).collect()] == [row]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("_")] == []


def test_header_names_in_any_case(spark, tmp_path) -> None:
    (tmp_path / "mcc.csv").write_text("Code,ID\n0742,7\n")
    read = read_merchant_categories(spark, str(tmp_path / "mcc.csv"))
    assert read.columns == ["id", "code"]
    assert read.collect() == [("7", "0742")]


def launched(tmp_path, lines, *options) -> list[list[str]]:
    """The fields of the December report the launcher writes for these transactions."""
    (tmp_path / "mcc.csv").write_text("id,code\n7,0742\n3000000007.0,0743\nm7,0744\n")
    (tmp_path / "tx.csv").write_text(TX_HEADER + "".join(lines))
    inputs = ["--transactions", f"{tmp_path}/tx.csv", "--categories", f"{tmp_path}/mcc.csv"]
    main([*inputs, "--output", f"{tmp_path}/out", *options])
    text = (tmp_path / "out/ACME_20181231.csv").read_text()
    return sorted(line.split("|") for line in text.splitlines()[1:])


def line_of(category: str, amount: str, date: str = "2018-12-03") -> str:
    return f"n,{category},{date},{amount},payment01,type01,brand01,A029,\n"


@pytest.mark.parametrize("profile", ["as_implemented", "as_specified"])
def test_ids_of_any_form_find_their_code(spark, tmp_path, profile) -> None:
    ids = ["7", "007", "7.0", "+7", " 7 ", "3000000007", "m7", " m7", "7.5", "M7", "-7", ""]
    rows = launched(tmp_path, [line_of(key, "1.00") for key in ids], "--profile", profile)
    assert [(row[5], row[7]) for row in rows] == [
        ("0742", "5"),
        ("0743", "1"),
        ("0744", "2"),
        ("9999", "4"),
    ]


@pytest.mark.parametrize("profile", ["as_implemented", "as_specified"])
def test_fine_and_large_amounts_are_summed_before_rounding(spark, tmp_path, profile) -> None:
    fine = [line_of("7", "0.004")] * 1000
    large = [line_of("m7", "20000000000000000.00")]
    rows = launched(tmp_path, fine + large, "--profile", profile)
    assert [Decimal(row[6]) for row in rows] == [Decimal(4), Decimal("20000000000000000")]
    assert [row[7] for row in rows] == ["1000", "1"]


MALFORMED = [
    line_of("7", "12x"),
    line_of("7", "1.00", "03/12/2018"),
    "n,7,2018-12-03,1.00,payment01\n",
]


@pytest.mark.parametrize("bad", MALFORMED)
def test_malformed_records_fail_the_run(spark, tmp_path, bad) -> None:
    with pytest.raises(Exception, match="MALFORMED"):
        launched(tmp_path, [line_of("7", "100.00"), bad])
    assert not list((tmp_path / "out").glob("*"))


def test_malformed_records_are_counted_if_kept(spark, tmp_path, capsys) -> None:
    rows = launched(tmp_path, [line_of("7", "100.00"), *MALFORMED], "--keep-malformed")
    assert "Malformed transactions: 3" in capsys.readouterr().out
    assert len(rows) == 2


def test_an_earlier_month_stays_if_the_move_fails(spark, tmp_path) -> None:
    write_monthly_files(report_of(spark, [DECEMBER]), str(tmp_path))
    december = (tmp_path / "ACME_20181231.csv").read_bytes()
    # A folder that holds something cannot be replaced by a file.
    (tmp_path / "ACME_20181130.csv" / "x").mkdir(parents=True)
    with pytest.raises(Exception, match="ACME_20181130"):
        write_monthly_files(report_of(spark, [NOVEMBER, DECEMBER]), str(tmp_path))
    assert (tmp_path / "ACME_20181231.csv").read_bytes() == december
    assert not [name for name in os.listdir(tmp_path) if name.startswith("_staging")]


def test_launcher_writes_a_directory_per_month(spark, tmp_path) -> None:
    (tmp_path / "mcc.csv").write_text("id,code\n7,0742\n")
    (tmp_path / "tx.csv").write_text(TX_HEADER + line_of("7", "1.00"))
    inputs = ["--transactions", f"{tmp_path}/tx.csv", "--categories", f"{tmp_path}/mcc.csv"]
    assert main([*inputs, "--output", f"{tmp_path}/out", "--sink", "partitions"]) == 1
    assert data_files(tmp_path / "out") == ["report_file=ACME_20181231"]


@pytest.mark.parametrize("small", [True, False])
def test_launcher_with_dated_categories(spark, tmp_path, capsys, monkeypatch, small) -> None:
    if not small:
        monkeypatch.setattr("tallymonth.__main__.fits_broadcast", lambda versions: False)
    columns = "date,amount,payment_method,card_type,card_brand,card_country_issuer_code,backend_name,merchant_category_id"
    lines = [f"2018-12-{day:02},{amount},payment01,type01,brand01,A029,,007" for day, amount in ((1, 1), (5, 10), (9, 100), (9, "x"))]
    (tmp_path / "tx.csv").write_text("\n".join([columns, *lines]) + "\n")
    (tmp_path / "mcc.csv").write_text("id,code,valid_from\n7,0742,2018-12-05\n7.0,0743,2018-12-09\n8,0001,\n")
    argv = ["--transactions", f"{tmp_path}/tx.csv", "--categories", f"{tmp_path}/mcc.csv", "--output", f"{tmp_path}/out"]
    argv += ["--profile", "as_specified", "--dated-categories", "--keep-malformed"]
    assert main(argv) == 3
    assert "Malformed transactions: 1" in capsys.readouterr().out
    found = read_monthly_files(spark, f"{tmp_path}/out").collect()
    assert {(r.merchant_category_code, r.amount, r.number) for r in found} == {
        ("9999", 1, 1), ("0742", 10, 1), ("0743", 100, 2)
    }


def test_versions_and_periods_are_read_with_their_dates(spark, tmp_path) -> None:
    (tmp_path / "versions.csv").write_text("code,id,valid_from,more\n0742,07,2018-12-05,x\n,8,,y\n9,9,05/12/2018,z\n")
    found = read_category_versions(spark, f"{tmp_path}/versions.csv").collect()
    assert [tuple(r) for r in found] == [("07", "0742", datetime.date(2018, 12, 5)), ("8", None, None), ("9", "9", None)]
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_category_versions(spark, f"{tmp_path}/versions.csv", fail_on_malformed=True).collect()
    (tmp_path / "fees.csv").write_text("id,fee_code,rate,starts,ends\n7,f,0.0125,2018-01-01,\n")
    (fee,) = read_fee_periods(spark, f"{tmp_path}/fees.csv").collect()
    assert tuple(fee) == ("7", "f", Decimal("0.0125"), datetime.date(2018, 1, 1), None)
