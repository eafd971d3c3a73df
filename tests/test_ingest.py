import os
import tempfile

from pricelens.sources import ingest as IN
from pricelens.spec import load_schema

HEADER = ("UID,NAME,ZONE,Brand,MC,Fdate,NSU,NSV,GST Value,NSV-GST,Sales at Cost,(NSV-GST)-SALES AT COST,"
          "MARGIN%,Gross Sales,Gross RGM(P-L),Gross Margin %(Q/P*100),MRP,SP,DIS,DIS%")


def _row(uid, name="p", zone="EAST", date="2019-01-02", nsu="1.0"):
    nums = ",".join(["1.0"] * 13)
    return f'{uid},{name},{zone},B1,M1,{date},{nsu},{nums}'


def test_reject_split_and_nulls(spark):
    d = tempfile.mkdtemp(prefix="ingest-")
    src = os.path.join(d, "batch.csv")
    lines = [HEADER, _row(1), _row(2, name='"say ""hi"""'), _row(3, zone="MIDDLE"), _row(4, nsu="abc"),
             _row(5, name="null"), _row(6, name="")]
    with open(src, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    compiled, rejects = IN.ingest(spark, src, os.path.join(d, "table"))
    reasons = {r["UID"]: r["reason"] for r in rejects.collect()}
    assert "ZONE longer than 5" in reasons[3]
    assert "unparseable" in reasons[4]
    good = {r["UID"]: r for r in compiled.collect()}
    assert set(good) == {1, 2, 5, 6}
    assert good[2]["NAME"] == 'say "hi"'
    assert good[5]["NAME"] is None and good[6]["NAME"] is None
    # idempotent re-load: append again, the distinct read-back is unchanged
    compiled2, _ = IN.ingest(spark, src, os.path.join(d, "table"))
    assert compiled2.count() == 4


def test_schema_json():
    s = load_schema()
    assert len(s.names) == 20 and s.max_lengths["ZONE"] == 5
    assert s.struct["Fdate"].dataType.simpleString() == "date"


def test_missing_columns_keep_their_type(spark):
    schema = load_schema()
    path = os.path.join(tempfile.mkdtemp(prefix="table-"), "t")
    cols = IN.ensure_table(spark, path, schema)
    narrow = spark.createDataFrame([(1, "a")], f"{cols[0]} {schema.struct[cols[0]].dataType.simpleString()}, {cols[1]} string")
    IN.append_positional(narrow, path, cols)
    full = spark.createDataFrame([], schema.struct).select(*[f"`{c}`" for c in cols])
    IN.append_positional(full, path, cols)
    back = IN.read_table(spark, path)
    assert back.count() == 1
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in schema.struct}
