import pytest
from pyspark.sql import types as T

from regista.sources.landing import read_landing_json, read_landing_records

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("places", T.IntegerType()),
                       T.StructField("tags", T.ArrayType(T.StringType()))])


@pytest.fixture
def landing(tmp_path):
    def write(**pages):
        for name, text in pages.items():
            (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def _rows(df):
    return sorted(((r._page.rsplit("/", 1)[1], r._position, r.id, r.places, r.tags, r._fault, r._record) for r in df.collect()),
                  key=str)


def test_bad_records_are_set_aside_with_their_page(spark, landing):
    path = landing(
        a='\n [{"id": "x", "places": 3, "tags": ["p", "q"]}, {"id": "y", "places": "many"}, 7, null, {"places": null, "other": 1}]',
        b='{"id": "single", "places": 4}', c="[]", d='[{"id": "cut"', e="")
    got = _rows(read_landing_records(spark, path, SCHEMA, "*.json"))
    assert got == sorted([
        ("a.json", 0, "x", 3, ["p", "q"], None, None),
        ("a.json", 1, None, None, None, "places", '{"id":"y","places":"many"}'),
        ("a.json", 2, None, None, None, "record", "7"),
        ("a.json", 3, None, None, None, "record", "null"),
        ("a.json", 4, None, None, None, None, None),
        ("b.json", 0, "single", 4, None, None, None),
        ("d.json", None, None, None, None, "page", None)], key=str)


def test_good_pages_read_alike(spark, landing):
    path = landing(a='[{"id": "x", "places": 3}, {"id": "y"}]', b='[{"id": "x", "places": 3}]')
    plain = read_landing_json(spark, path, SCHEMA, "*.json").collect()
    typed = read_landing_records(spark, path, SCHEMA, "*.json").select("id", "places", "tags").collect()
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, typed), key=str) and len(plain) == 3


@pytest.mark.parametrize("read", [read_landing_json, read_landing_records])
def test_large_pages_are_refused_unread(spark, landing, read):
    path = landing(small="[]", large="[" + " " * 2000 + "broken")
    with pytest.raises(ValueError, match="large.json .2007 bytes"):
        read(spark, path, SCHEMA, "*.json", max_page_bytes=1000)


def test_json_lines_have_no_largest_size(spark, landing):
    path = landing(lines='{"id": "x"}\n' * 200)
    assert read_landing_json(spark, path, SCHEMA, "*.json", json_lines=True, max_page_bytes=10).count() == 200


def test_no_page_of_the_name(spark, landing):
    assert read_landing_records(spark, landing(a="[1]"), SCHEMA, "*.txt").count() == 0
