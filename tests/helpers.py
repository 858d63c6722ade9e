import datetime as dt

from tillroll.schemas import TRANSACTIONS


def txn(spark, records):
    """Transactions from partial dicts; missing columns are NULL."""
    names = [f.name for f in TRANSACTIONS.fields]
    full = [tuple(r.get(n) for n in names) for r in records]
    return spark.createDataFrame(full, TRANSACTIONS)


def day(s):
    return dt.date.fromisoformat(s)
