"""Small hand-made panels."""

import datetime as dt

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def panel(spark, rows):
    """Rows of (city, day number, pm2_5)."""
    data = [(c, day(d), v) for c, d, v in rows]
    return spark.createDataFrame(data, "city string, date date, pm2_5 double")


def by_key(df, *columns):
    """{(city, date): values} of the named columns."""
    rows = df.collect()
    return {(r.city, r.date): tuple(r[c] for c in columns) for r in rows}
