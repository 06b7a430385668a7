"""Masking by policy and keyed pseudonyms."""

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from almacen.functions import privacy
from almacen.functions.privacy import DROP, KEEP, MASK, MONTH, PSEUDONYM, Keys

KEYS = Keys({"a": b"first", "b": b"k" * 100}, "a")


def test_pseudonyms_are_hmac(spark):
    df = spark.createDataFrame([("ñandú",), ("",), (None,)], "x string")
    for version, key in KEYS.by_version.items():
        got = [r[0] for r in df.select(privacy.pseudonym("x", KEYS, version)).collect()]
        want = [f"{version}:{hmac.new(key, x.encode(), hashlib.sha256).hexdigest()}" for x in ("ñandú", "")]
        assert got == [*want, None]


def test_policy_treats_every_column_and_drops_what_it_does_not_name(spark):
    df = spark.createDataFrame([(7, "Ana 12", dt.date(2024, 5, 17), "x", "new")], "id int, name string, day date, gone string, unnamed string")
    out = privacy.apply_policy(df, {"id": PSEUDONYM, "name": MASK, "day": MONTH, "gone": DROP}, KEYS)
    assert out.columns == ["id", "name", "day"]
    row = out.first()
    assert row.id.startswith("a:") and row.name == "Xxx nn" and row.day == dt.date(2024, 5, 1)
    with pytest.raises(ValueError, match="unknown rules"):
        privacy.apply_policy(df, {"id": "blur"})
    with pytest.raises(ValueError, match="need keys"):
        privacy.apply_policy(df, {"id": PSEUDONYM})


def test_tables_join_on_pseudonyms_before_and_after_a_rotation(spark):
    people = spark.createDataFrame([(i, f"n{i}") for i in range(20)] + [(None, "none")], "id int, name string")
    bought = spark.createDataFrame([(i % 25, i) for i in range(60)], "id int, amount int")
    policy = {"id": PSEUDONYM, "name": KEEP, "amount": KEEP}
    a, b = (privacy.apply_policy(t, policy, KEYS) for t in (people, bought))
    plain = people.join(bought, "id").groupBy("name").agg(F.sum("amount").alias("s"))
    assert sorted(a.join(b, "id").groupBy("name").agg(F.sum("amount").alias("s")).collect()) == sorted(plain.collect())
    walk = privacy.crosswalk(people.select("id").union(bought.select("id")), "id", KEYS, "a", "b")
    a2, b2 = (privacy.rotate(t, "id", walk) for t in (a, b))
    assert a2.join(a, "id").isEmpty() and a2.count() == a.count() and b2.where("id NOT LIKE 'b:%'").isEmpty()
    assert sorted(a2.join(b2, "id").groupBy("name").agg(F.sum("amount").alias("s")).collect()) == sorted(plain.collect())
    assert privacy.rotate(a2, "id", walk).exceptAll(a2).isEmpty()
