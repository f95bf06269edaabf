import pytest
from pyspark.sql import functions as F

from screenwell.fixed_values import ALL_ITEMS
from screenwell.operators.summary import population_checks
from screenwell.operators.validate import check_records
from screenwell.sources.generator import clinical_table, population_table, row_ids
from screenwell.sources.files import screening_schema


def test_schema_and_size(spark):
    df = population_table(row_ids(spark, 200), seed=7)
    assert df.columns == [f.name for f in screening_schema()] and df.count() == 200
    clinical = clinical_table(row_ids(spark, 200), seed=7)
    assert len(clinical.columns) == 29 and clinical.count() == 200


@pytest.mark.parametrize("make", [population_table, clinical_table])
def test_items_totals_and_bands(spark, make):
    row = check_records(make(row_ids(spark, 500), seed=7)).first()
    assert row.n_rows == 500 and sum(row[1:]) == 0


def test_clinical_distribution(spark):
    row = population_checks(clinical_table(row_ids(spark, 5000), seed=7)).first()
    assert 0.4 < row.total_correlation < 0.8
    assert 0.15 < row.prevalence_10 < 0.40
    assert row.si_rate_severe > 3 * (row.si_rate_none or 0)


def test_population_distribution(spark):
    df = population_table(row_ids(spark, 5000), seed=7)
    row = population_checks(df).first()
    assert 0.3 < row.total_correlation < 0.8
    assert df.filter("on_medication AND NOT prior_diagnosis").count() == 0


def test_same_seed_same_rows_for_any_partitioning(spark):
    one = clinical_table(row_ids(spark, 300).repartition(1))
    many = clinical_table(row_ids(spark, 300).repartition(7))
    assert one.exceptAll(many).count() == 0
    other = clinical_table(row_ids(spark, 300), seed=8)
    assert one.exceptAll(other).count() > 0


def test_groups_order_totals(spark):
    means = [r.m for r in clinical_table(row_ids(spark, 3000)).groupBy("severity_group").agg(
        F.avg("phq9_total").alias("m")).orderBy("severity_group").collect()]
    assert means == sorted(means) and len(ALL_ITEMS) == 16
