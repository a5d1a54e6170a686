"""Replace-by-day into a relational table.

``browser_stat(day varchar(10) not null, browser varchar(100) not null, cnt int)``.
The day's old rows are deleted and the new ones inserted in one transaction
over a staging table, so readers never see a half-written day and a rerun is
idempotent.  The JDBC driver must be on the cluster's classpath.

This sink is not exercised by the test suite: the container offers no
database server and the rules of this build forbid starting one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _jdbc_connection(spark, url: str, props: dict[str, str]):
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def replace_day_jdbc(rows: DataFrame, url: str, table: str, day: str,
                     props: dict[str, str] | None = None, writers: int = 4) -> None:
    """Write ``rows (day, browser, cnt)`` of ``day`` into ``table``.

    1. rows -> ``<table>_staging`` (overwrite, ``writers`` parallel connections);
    2. one transaction on the driver: delete the day, insert from staging.
    """
    props = dict(props or {})
    staging = f"{table}_staging"
    (rows.select("day", "browser", "cnt").coalesce(writers)
         .write.mode("overwrite").jdbc(url, staging, properties=props))
    conn = _jdbc_connection(rows.sparkSession, url, props)
    try:
        conn.setAutoCommit(False)
        st = conn.prepareStatement(f"DELETE FROM {table} WHERE day = ?")
        st.setString(1, day)
        st.executeUpdate()
        st.close()
        ins = conn.prepareStatement(
            f"INSERT INTO {table} (day, browser, cnt) SELECT day, browser, cnt FROM {staging} WHERE day = ?")
        ins.setString(1, day)
        ins.executeUpdate()
        ins.close()
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
