"""Readers, filters, sinks."""

from vitrine.operators import filters as FL
from vitrine.sources import sinks as SK
from vitrine.sources import tables as TB


def test_table_readers_and_sink(spark):
    df = spark.createDataFrame([(1, "tv", 10.0, "/tv", "Tv"), (2, None, 5.0, "/x", "Tv"), (3, "pc", None, "/pc", "Pc")],
                               "id long, title string, price double, link string, categoria string")
    SK.save_table(df, "feed_x")  # A6
    assert spark.table("feed_x").count() == 3
    feed = TB.scan_feed(spark, "feed_x")  # A2 + B3
    assert feed.columns == ["id_tabela", "titulo_tabela", "preco_tabela", "url_tabela"] and feed.count() == 1
    df.withColumnRenamed("link", "url").createOrReplaceTempView("listing_x")
    s = TB.scan_with_suffix(spark, "listing_x", "site")  # A1 + B1 + B4
    assert s.columns == ["title_site", "price_site", "url_site"] and s.count() == 2
    assert TB.scan_for_embedding(spark, "listing_x").columns == ["title", "price", "url", "categoria"]  # A3
    both = TB.read_categories(spark, ["listing_x", "listing_x"])  # A4 + U1
    assert both.count() == 6
    names = [r.tableName for r in TB.list_tables(spark).collect()]  # A13
    assert "feed_x" in names and "listing_x" in names


def test_listing_filters(spark):
    df = spark.createDataFrame([("a", "10", "/a"), ("b", "x", "/b"), (None, "3", "/c"), ("d", "0", ""), ("e", "NaN", "/e")],
                               "title string, price string, url string")
    assert sorted(r.title for r in FL.keep_priced(df).collect() if r.title) == ["a", "d"]  # B2 (NaN dropped)
    assert FL.require_title_and_price(df).count() == 4  # B3
    assert FL.drop_untitled(df).count() == 4  # B4
    priced = df.withColumn("price", df.price.try_cast("double"))
    assert [r.title for r in FL.valid_listings(priced, "strict").collect()] == ["a"]  # B5
    assert sorted(r.title for r in FL.valid_listings(priced, "lenient").collect()) == ["a", "b", "e"]  # B6
    assert FL.valid_listings(priced, "tag").count() == 4  # B7


def test_category_partitions_read_back_whole(spark, tmp_path):
    """A7 -> A4 + U1: per-category reads of a partitioned table, each
    pruned to its folder, give back every row once (others and nulls too)."""
    df = spark.createDataFrame([(1, "tv", "Tv"), (2, "pc", "Pc"), (3, "fan", "Home"), (4, "cup", None)],
                               "id long, title string, category string")
    path = str(tmp_path / "bronze")
    SK.save_by_category(df, path)
    got = TB.read_category_partitions(spark, path, ["Tv", "Pc"])
    assert sorted((r.id, r.category) for r in got.collect()) == [(1, "Tv"), (2, "Pc"), (3, "Home"), (4, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(category") == 2 and "Exchange" not in plan
