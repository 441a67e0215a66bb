"""Broken documents and lines raise, or are handed over; they never vanish."""

import pytest

from panelcast.sources import files, payloads
from panelcast.spec import AIR_PAYLOAD

GOOD = '{"city":"a","hourly":{"time":["2024-01-01T00:00"],"pm2_5":[1.0],"pm10":[2.0]}}'
CUT = GOOD[:-9]
TEXT = GOOD.replace("[1.0]", '["high"]')
NAMELESS = GOOD.replace('"city":"a",', "")


def landed(tmp_path, *lines):
    (tmp_path / "part.json").write_text("\n".join(lines))
    return str(tmp_path)


@pytest.mark.parametrize("broken", [CUT, TEXT, NAMELESS])
def test_a_broken_document_raises(spark, tmp_path, broken):
    path = landed(tmp_path, GOOD, broken)
    with pytest.raises(Exception):
        payloads.read_air(spark, path).collect()


def test_refused_documents_are_a_table(spark, tmp_path):
    good, bad = payloads.sorted_out(spark, landed(tmp_path, GOOD, CUT, TEXT, NAMELESS), AIR_PAYLOAD)
    assert good.count() == 1
    assert {(r.document, r.reason) for r in bad.collect()} == {
        (CUT, "not readable"), (TEXT, "not readable"), (NAMELESS, "no city"),
    }


@pytest.mark.parametrize("line", ["2024-01-01T01:00,1.0", "2024-01-01T01:00,x7,2.0", "2024-01-01T01:00,1,2,3"])
def test_a_broken_line_raises(spark, tmp_path, line):
    (tmp_path / "air.csv").write_text(f"time,PM10,PM2.5\n2024-01-01T00:00,,2.0\n{line}\n")
    with pytest.raises(Exception):
        files.read_air_csv(spark, str(tmp_path / "air.csv")).select("pm10").collect()
    (tmp_path / "air.csv").write_text("time,PM10,PM2.5\n2024-01-01T00:00,,2.0\n")
    assert files.read_air_csv(spark, str(tmp_path / "air.csv")).first().pm10 is None
