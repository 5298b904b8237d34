"""Normalisation on hand-made edge cases, against a small model in plain Python."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillwork.operators.normalize import normalize_source
from rillwork.plans import entities
from rillwork.sources.schemas import SOURCE, SchemaMismatch, require_exact

CASES = {
    None: ("", "", ""),
    "ﬁnance Straße": ("finance strasse", "financestrasse", ""),
    "１２ Main": ("12 main", "12main", "12"),
    "१२ रोड": ("", "", "१२"),
    "½ St": ("1 2 st", "12st", "1 2"),
    "x²": ("x2", "x2", "2"),
    "a b": ("a b", "ab", ""),
    "Äcmé  Co., #12/b": ("cm co 12 b", "cmco12b", "12"),
    "10 9 Elm 560001": ("10 9 elm 560001", "109elm560001", "10 9 560001"),
    "": ("", "", ""),
}


def model(text):
    folded = unicodedata.normalize("NFKC", text or "").casefold()
    norm = re.sub("[^a-z0-9]+", " ", folded).strip()
    return norm, re.sub("[^a-z0-9]+", "", folded), " ".join(re.findall(r"\d+", folded))


def normalised(spark, texts):
    rows = spark.createDataFrame([(str(i), t, t, t) for i, t in enumerate(texts)], SOURCE)
    return {int(r["entity_id"]): r for r in normalize_source(rows).collect()}


def test_edge_table(spark):
    got = normalised(spark, CASES)
    for i, (raw, want) in enumerate(CASES.items()):
        r = got[i]
        assert (r["business_name_norm"], r["business_name_compact"], r["business_name_numeric_tokens"]) == want == model(raw)
        assert r["business_name_alnum"] == r["business_name_compact"] and r["business_name_tokens"] == r["business_name_norm"]


def test_address_forms(spark):
    r = normalised(spark, ["10 9 Elm 560001"])[0]
    assert r["business_address_sorted_tokens"] == "10 560001 9 elm"
    assert (r["business_address_house_number"], r["business_address_postal_tokens"], r["business_address_alpha_tokens"]) == ("10", "560001", "elm")
    assert r["country_norm"] == "10 9 Elm 560001"


def test_no_derived_column_is_null(spark):
    r = normalised(spark, [None])[0]
    assert all(v == "" for k, v in r.asDict().items() if k not in ("entity_id", "business_name", "business_address", "country"))


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=20, max_size=40))
def test_matches_plain_python(spark, texts):
    got = normalised(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["business_name_norm"], r["business_name_compact"], r["business_name_numeric_tokens"]) == model(t)


def test_schema_is_checked_by_name_and_order(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], SOURCE)
    assert require_exact(df, SOURCE) is df
    with pytest.raises(SchemaMismatch):
        require_exact(df.select("business_name", "entity_id", "business_address", "country"), SOURCE)
    with pytest.raises(SchemaMismatch):
        normalize_source(df.drop("country"))


def test_every_document_is_an_entity(spark):
    d = "/root/testdata/sf0.001"
    assert entities.entities(spark, d).count() == spark.read.parquet(f"{d}/documents.parquet").count()
