"""The README's example runs as it stands."""

from __future__ import annotations

import re
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

README = Path(__file__).resolve().parent.parent / "README.md"


def test_example(spark, tmp_path, capsys):
    text = re.search(r"```python\n(.*?)```", README.read_text(), re.DOTALL)[1]
    for folder in ("/data/", "/reports", "/out"):
        text = text.replace(f'"{folder}', f'"{tmp_path}{folder}')
    day = F.to_date(F.lit("2001-03-04"))
    columns = {"entry_date": day, "kind": F.lit("revenue"), "account": F.lit("fees "), "sub_code": F.lit("4.1.4"), "unit": F.lit("u")}
    spark.range(1).select(*[c.alias(n) for n, c in columns.items()], F.lit(12.5).alias("value")).write.parquet(f"{tmp_path}/data/ledger")
    late = {**columns, "kind": F.lit("Expense"), "amount": F.lit(3).cast("decimal(26,8)")}
    names = {"spark": spark, "late_postings": spark.range(2).select(*[c.alias(n) for n, c in late.items()])}
    exec(compile(text, str(README), "exec"), names)
    shown = capsys.readouterr().out
    assert shown.count("R$ 12,50") == 8 and "INTEREST" in shown
    assert dict((r[0], r[3]) for r in names["audit"].rows())["reported"] == Decimal("12.5")
    assert names["cells"].read(2001).agg(F.sum("amount")).first()[0] == Decimal("18.5")
