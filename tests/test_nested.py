"""Records cut by depth, over splits of any size."""

import random

import pytest

from idtrail.sources.nested import record_texts, scan_xml_by_depth

NOISE = [
    "<!-- </m> -->", "<!-- <m> -->", "<![CDATA[</m>]]>", "<![CDATA[ <m> <!-- ]]>", "<?p </m> ?>", "<m/>", "<m a='>' b=\"/>\" />", "<ma></ma>",
    "<m>in</m>", "<m a='/>'>x<m>deep</m></m>", "text é", "\n",
]


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    yield lambda size: [spark.conf.set(k, str(size)) for k in keys]
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("size", [37, 150, 1000, 1 << 20])
def test_records_over_splits(spark, rows, tmp_path, small_splits, size):
    deal = random.Random(size)
    expected = []
    for f in range(2):
        text = "<?xml version='1.0'?>\n<!-- <m></m> --><all>"
        for i in range(40):
            record = f"<m k='{f}.{i}'>" + "".join(deal.choices(NOISE, k=deal.randrange(6))) + "</m>"
            expected.append(record)
            text += deal.choice(["", "\n", "<!-- </m> <m> -->", "<m/>", "<n></n>"]) + record
        (tmp_path / f"{f}.xml").write_text(text + "<!-- </m> --></all>\n")
    small_splits(size)
    found = record_texts(spark, str(tmp_path), "m")
    assert rows(found) == sorted((r,) for r in expected)


def test_one_record_over_many_splits(spark, rows, tmp_path, small_splits):
    inner = "<m>x</m><!-- </m> -->" * 200
    (tmp_path / "a.xml").write_text(f"<a><m>first</m><m>{inner}</m><m>last</m></a>")
    small_splits(64)
    assert rows(record_texts(spark, str(tmp_path), "m")) == sorted([("<m>first</m>",), (f"<m>{inner}</m>",), ("<m>last</m>",)])


def test_records_and_empty_files(spark, rows, tmp_path):
    (tmp_path / "a.xml").write_text("")
    assert rows(scan_xml_by_depth(spark, str(tmp_path))) == []
    one = "<metabolite><accession>{}</accession><!-- </metabolite> --><secondary_accessions/></metabolite>"
    (tmp_path / "b.xml").write_text("<all>" + one.format("H1") + one.format("H2") + "</all>")
    assert rows(scan_xml_by_depth(spark, str(tmp_path)), "primaryID") == [("H1",), ("H2",)]


def test_other_splits_end_the_job(spark, tmp_path, small_splits):
    (tmp_path / "a.xml").write_text("<a>" + "<m>x</m>" * 100 + "</a>")
    small_splits(64)
    found = record_texts(spark, str(tmp_path), "m")
    small_splits(100)
    with pytest.raises(Exception, match="other splits"):
        found.collect()
