"""Licence quotas, invoices and job reports, as the service specifications describe them (extras)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LICENCES = "SELECT c_custkey AS customer, CAST(1000 + c_custkey % 7 * 50 AS BIGINT) AS quota, DATE '1995-01-01' AS starts, DATE '1996-01-01' AS ends, CAST(c_custkey % 5 * 10 + 99 AS DECIMAL(10,2)) AS base, CAST(0.05 AS DECIMAL(5,4)) AS overage FROM {customer}"
USAGE = "SELECT o_custkey AS customer, o_orderdate AS used_at, CAST(o_orderkey % 200 AS BIGINT) AS images, o_orderkey AS job FROM {orders}"
JOBS = "SELECT event_id, ts, user_id % 40 AS job, event_id % 9 < 7 AS good, event_id % 31 = 0 AS failed, event_type AS category FROM {events}"


def used_in_period(licences: DataFrame, usage: DataFrame) -> DataFrame:
    """Licences with the images used within their period; a range condition on an equi-join."""
    u = usage.groupBy("customer", F.to_date("used_at").alias("day")).agg(F.sum("images").alias("images"))
    inside = licences.join(u, "customer").where("day >= starts and day < ends").groupBy("customer").agg(F.sum("images").alias("used"))
    return licences.join(inside, "customer", "left").withColumn("used", F.coalesce("used", F.lit(0)))


def quota_remaining(licences: DataFrame, usage: DataFrame) -> DataFrame:
    return used_in_period(licences, usage).select("customer", "quota", "used", (F.col("quota") - F.col("used")).alias("remaining"))


def usage_by_month(usage: DataFrame) -> DataFrame:
    return usage.groupBy(F.date_format("used_at", "yyyy-MM").alias("month")).agg(F.sum("images").alias("images"), F.count("*").alias("jobs"))


def invoice_overage(licences: DataFrame, usage: DataFrame) -> DataFrame:
    over = F.greatest(F.lit(0), F.col("used") - F.col("quota"))
    return used_in_period(licences, usage).select("customer", over.alias("over"), (F.col("base") + over.cast("decimal(10,0)") * F.col("overage")).cast("decimal(10,2)").cast("double").alias("total"))


def quota_warnings(licences: DataFrame, usage: DataFrame) -> DataFrame:
    share = F.col("used") / F.col("quota")
    return used_in_period(licences, usage).select("customer", F.when(share >= 0.95, "critical").when(share >= 0.8, "warning").otherwise("none").alias("level"))


def dashboard_totals(usage: DataFrame) -> DataFrame:
    return usage.agg(F.sum("images").alias("images"), F.count("*").alias("jobs"), F.count_distinct("customer").alias("customers"))


def dashboard_top_customers(usage: DataFrame, n: int = 10) -> DataFrame:
    return usage.groupBy("customer").agg(F.sum("images").alias("images")).orderBy(F.desc("images"), "customer").limit(n)


def job_counters(jobs: DataFrame) -> DataFrame:
    flagged = ~F.col("good") & ~F.col("failed")
    return jobs.groupBy("job").agg(F.count("*").alias("processed"), F.count_if(F.col("good") & ~F.col("failed")).alias("success"), F.count_if(flagged).alias("flagged"), F.count_if("failed").alias("failed"))


def job_lifecycle(jobs: DataFrame, expected: int = 60) -> DataFrame:
    """State of each job: processing until all its images are there, then reviewing if any is flagged, else complete."""
    d = job_counters(jobs)
    return d.select("job", F.when(F.col("processed") < expected, "processing").when(F.col("flagged") > 0, "reviewing").otherwise("complete").alias("state"))


def usage_7day(jobs: DataFrame) -> DataFrame:
    d = jobs.groupBy(F.window("ts", "7 days").alias("w")).agg(F.count("*").alias("n"), F.count_if("good").alias("good"))
    return d.select(F.date_format("w.start", "yyyy-MM-dd").alias("week"), "n", F.round(F.col("good") / F.col("n"), 4).alias("success_rate"))


def usage_event_report(jobs: DataFrame) -> DataFrame:
    """Counts of each job's categories, put into a map and taken out of it again."""
    counts = jobs.groupBy("job", "category").agg(F.count("*").alias("n"))
    maps = counts.groupBy("job").agg(F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("categories"))
    return maps.select("job", F.explode("categories").alias("category", "n"))


QUERIES: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "quota_remaining": lambda rel: quota_remaining(rel(LICENCES), rel(USAGE)),
    "usage_by_month": lambda rel: usage_by_month(rel(USAGE)),
    "invoice_overage": lambda rel: invoice_overage(rel(LICENCES), rel(USAGE)),
    "quota_warnings": lambda rel: quota_warnings(rel(LICENCES), rel(USAGE)),
    "dashboard_totals": lambda rel: dashboard_totals(rel(USAGE)),
    "dashboard_top_customers": lambda rel: dashboard_top_customers(rel(USAGE)),
    "job_counters": lambda rel: job_counters(rel(JOBS)),
    "job_lifecycle": lambda rel: job_lifecycle(rel(JOBS)),
    "usage_7day": lambda rel: usage_7day(rel(JOBS)),
    "usage_event_report": lambda rel: usage_event_report(rel(JOBS)),
}
