"""Ad-hoc SELECT over sales and its views, in a session of its own."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.tables import publish
from .views import create_views

# Built-in functions that call JVM methods by name.
JVM_CALLS = ("reflect", "try_reflect", "java_method")
# Plan node of SELECT TRANSFORM, which pipes rows through a program.
_PROGRAM = re.compile(r'"class":"[^"]*ScriptTransformation"')


class AdHoc:
    """A session that knows neither files by path nor functions that call the JVM.

    Both are taken out of this session alone, once, so requests can run side by
    side and other sessions keep them. Names that are built from strings at run
    time resolve no better than written ones.
    """

    def __init__(self, spark: SparkSession):
        self.session = configure(spark.newSession())
        self.session.conf.set("spark.sql.runSQLOnFiles", "false")
        registry = self.session._jsparkSession.sessionState().functionRegistry()
        for name in JVM_CALLS:
            registry.dropFunction(spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name))

    def register(self, sales: DataFrame, name: str = "sales") -> list[str]:
        """Make sales and its views visible to requests."""
        shared = f"{name}_{uuid.uuid4().hex}"
        publish(sales).createGlobalTempView(shared)
        try:
            rows = self.session.table(f"global_temp.{shared}")
            rows.createOrReplaceTempView(name)
        finally:
            sales.sparkSession.catalog.dropGlobalTempView(shared)
        return create_views(self.session, name)

    def select(self, sql: str | None) -> DataFrame:
        """The result of one SELECT on registered and catalog names.

        ``ValueError`` without a statement, ``PermissionError`` unless it starts
        with SELECT and runs no external program; what Spark finds wrong is
        raised as is.
        """
        if sql is None:
            raise ValueError("no sql given")
        text = sql.strip()
        if not text.upper().startswith("SELECT"):
            raise PermissionError("a request is a single SELECT")
        result = self.session.sql(text)
        if _PROGRAM.search(result._jdf.queryExecution().analyzed().toJSON()):
            raise PermissionError("a request runs no external program")
        return result

    def request(self, body: Mapping | None) -> DataFrame:
        """``select`` for a request body that must hold ``sql``."""
        if not body or "sql" not in body:
            raise ValueError("the request holds no 'sql'")
        return self.select(body["sql"])
