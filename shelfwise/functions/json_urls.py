"""URLs inside model-run documents `{"fm_res": [{"result": {...}}]}` (JS1-JS3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODEL_RUN = (
    "struct<fm_res:array<struct<result:struct<"
    "metric_url:string,"
    "trainfit_urls:array<struct<url:string>>,"
    "plot_urls:array<struct<url:string>>>>>>"
)


def _results(document: Column) -> Column:
    runs = F.from_json(document, MODEL_RUN)["fm_res"]
    return F.transform(F.coalesce(runs, F.array()), lambda run: run["result"])


def metric_urls(document: Column) -> Column:
    """The metric URL of every run that has one."""
    return F.filter(F.transform(_results(document), lambda r: r["metric_url"]), lambda u: u.isNotNull())


def _nested(document: Column, field: str) -> Column:
    present = F.filter(F.transform(_results(document), lambda r: r[field]), lambda urls: urls.isNotNull())
    urls = F.transform(F.flatten(present), lambda entry: entry["url"])
    return F.filter(urls, lambda u: u.isNotNull())


def fit_urls(document: Column) -> Column:
    return _nested(document, "trainfit_urls")


def plot_urls(document: Column) -> Column:
    return _nested(document, "plot_urls")
