"""Aggregations."""

from pyspark.sql import functions as F

from tallyforge.functions import tiers
from tallyforge.operators import aggregates, evaluation, mergeable, scans
from tallyforge.plans.customers import profiles
from tallyforge.plans.trips import by_direction
from tallyforge.session import stored
from tallyforge.workload.registry import day, query, r, rounded


@query("ag01_count", "SELECT count(*) AS row_count FROM lineitem")
def global_count(t):
    return t.lineitem.agg(F.count("*").alias("row_count"))


@query(
    "ag02_grouped",
    """SELECT l_suppkey, count(*) AS row_count, round(sum(l_extendedprice), 2) AS total,
              round(avg(l_extendedprice), 6) AS mean, min(l_extendedprice) AS smallest, max(l_extendedprice) AS largest
       FROM lineitem GROUP BY 1""",
)
def grouped(t):
    return rounded(aggregates.summarise(t.lineitem, ["l_suppkey"], "l_extendedprice"), total=2, mean=6)


@query(
    "ag03_rounded_mean",
    "SELECT category, round(avg(amount), 2) AS avg_transaction_value FROM transactions GROUP BY 1",
    "transactions",
)
def rounded_mean(t):
    return t.transactions.groupBy("category").agg(r(F.avg("amount")).alias("avg_transaction_value"))


@query("ag04_distinct", "SELECT category, count(DISTINCT customer_id) AS unique_customers FROM transactions GROUP BY 1", "transactions")
def distinct_count(t):
    return t.transactions.groupBy("category").agg(F.count_distinct("customer_id").alias("unique_customers"))


@query(
    "ag05_approx_distinct",
    "SELECT strftime(sold_at, '%Y-%m-%d') AS transaction_date, count(DISTINCT customer_id) AS active_customers, true AS close FROM sales GROUP BY 1",
    "sales",
)
def approx_distinct(t):
    """The approximate count next to the exact one: within three relative deviations."""
    daily = customers_by_day(t)
    return against_exact(t, mergeable.finished(daily, ACTIVE), "sold_on").select(day("sold_on").alias("transaction_date"), "active_customers", "close")


ACTIVE = {"approximate": mergeable.distinct("customer_id")}


def sold(t):
    on = F.to_date("sold_at")
    return t.sales.select("customer_id", on.alias("sold_on"), F.trunc(on, "week").alias("sold_in"))


def customers_by_day(t):
    """A sketch of the customers of each day, stored: any period is made of these."""
    return stored(mergeable.partials(sold(t), ["sold_on", "sold_in"], ACTIVE), "customers-by-day")


def against_exact(t, counts, key):
    exact = sold(t).groupBy(key).agg(F.count_distinct("customer_id").alias("active_customers"))
    off = F.abs(F.col("approximate") - F.col("active_customers"))
    bound = F.ceil(3 * mergeable.DISTINCT_ERROR * F.col("active_customers"))
    return counts.select(key, "approximate").join(exact, key).withColumn("close", off <= bound)


@query(
    "ag05b_weeks_from_days",
    """SELECT strftime(date_trunc('week', sold_at), '%Y-%m-%d') AS week_start, count(DISTINCT customer_id) AS active_customers, true AS close
       FROM sales GROUP BY 1""",
    "sales",
)
def weeks_from_days(t):
    """The customers of a week from the stored sketches of its days; the sales are read once, by day."""
    weekly = mergeable.finished(mergeable.merged(customers_by_day(t), ["sold_in"], ACTIVE), ACTIVE)
    return against_exact(t, weekly, "sold_in").select(day("sold_in").alias("week_start"), "active_customers", "close")


@query(
    "ag06_spread",
    """SELECT customer_id, round(stddev_samp(amount), 4) AS deviation,
              round(stddev_samp(amount) / avg(amount), 6) AS coefficient FROM transactions GROUP BY 1""",
    "transactions",
)
def spread(t):
    sd = F.stddev("amount")
    return t.transactions.groupBy("customer_id").agg(
        r(sd, 4).alias("deviation"), r(F.try_divide(sd, F.avg("amount")), 6).alias("coefficient")
    )


@query(
    "ag07_percentiles",
    """SELECT category, quantile_disc(amount, 0.25) AS p25, quantile_disc(amount, 0.5) AS p50,
              quantile_disc(amount, 0.75) AS p75, quantile_disc(amount, 0.95) AS p95 FROM transactions GROUP BY 1""",
    "transactions",
)
def percentiles(t):
    columns = aggregates.percentiles("amount", (0.25, 0.5, 0.75, 0.95), ("p25", "p50", "p75", "p95"))
    return t.transactions.groupBy("category").agg(*columns)


POINTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


@query(
    "ag07b_merged_quantiles",
    """SELECT category, quantile_disc(amount, 0.25) AS p25, quantile_disc(amount, 0.5) AS p50, quantile_disc(amount, 0.75) AS p75,
              quantile_disc(amount, 0.95) AS p95, true AS sketches_close FROM transactions GROUP BY 1""",
    "transactions",
)
def merged_quantiles(t):
    """Exact quantiles from sums over range partitions, and whether sketches stored by month and merged are within their bound.

    A sketched value is close if the share of amounts up to it, and that of amounts below it, enclose the point within the error.
    """
    measures = {"sketched": mergeable.quantiles("amount", list(POINTS.values()))}
    monthly = mergeable.partials(t.transactions, ["category", F.trunc("transaction_date", "month").alias("month")], measures)
    sketched = mergeable.finished(mergeable.merged(stored(monthly, "quantiles-by-month"), ["category"], measures), measures)
    amounts = t.transactions.groupBy("category", "amount").agg(F.count("*").alias("n"))
    exact = scans.weighted_quantiles(amounts, ["category"], "amount", "n", **POINTS)
    error, close = mergeable.RANK_ERROR, F.lit(True)
    for i, point in enumerate(POINTS.values()):
        guess = F.col("sketched")[i]
        up_to, below = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (F.col("amount") <= guess, F.col("amount") < guess))
        close = close & (up_to >= (point - error) * F.sum("n")) & (below <= (point + error) * F.sum("n"))
    known = amounts.join(sketched, "category").groupBy("category").agg(close.alias("sketches_close"))
    return exact.join(known, "category")


@query(
    "ag08_collect",
    """SELECT customer_id, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories
       FROM transactions GROUP BY 1""",
    "transactions",
)
def collect(t):
    sets = aggregates.collect_distinct(t.transactions, "customer_id", "category", "categories")
    return sets.withColumn("categories", F.array_join("categories", ","))


@query(
    "ag08b_pages",
    """SELECT category, page, count(*) AS length, min(customer_id) AS first_customer, max(customer_id) AS last_customer FROM (
         SELECT category, customer_id, CAST((row_number() OVER (PARTITION BY category ORDER BY customer_id) - 1) // 25 AS INTEGER) AS page
         FROM (SELECT DISTINCT category, customer_id FROM transactions)) GROUP BY 1, 2""",
    "transactions",
)
def pages(t):
    """All customers of a category, in arrays of bounded length."""
    found = aggregates.collect_pages(t.transactions, ["category"], "customer_id", "customers", page_size=25)
    return found.select(
        "category", "page", F.size("customers").cast("long").alias("length"),
        F.element_at("customers", 1).alias("first_customer"), F.element_at("customers", -1).alias("last_customer"),
    )


@query(
    "ag09_filtered",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
              count(*) FILTER (WHERE event_type IN ('click', 'view')) AS seen,
              strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
       FROM events WHERE user_id IS NOT NULL GROUP BY 1""",
)
def filtered(t):
    return t.spark.sql(
        """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
                  count_if(event_type IN ('click', 'view')) AS seen,
                  date_format(min(ts), 'yyyy-MM-dd HH:mm:ss') AS first_ts,
                  date_format(max(ts), 'yyyy-MM-dd HH:mm:ss') AS last_ts
           FROM {events} WHERE user_id IS NOT NULL GROUP BY user_id""",
        events=t.events,
    )


SPENT_BY_STATE = """
    SELECT customer_id, state, sum(amount) AS total_spent FROM transactions JOIN customers USING (customer_id) GROUP BY 1, 2
"""


@query(
    "ag10_conditional_share",
    f"""SELECT state, count(*) AS total_customers, sum(CASE WHEN total_spent > 2000000 THEN 1 ELSE 0 END)::BIGINT
               AS high_value_customers, round(avg(total_spent), 4) AS avg_spending_per_customer,
               round(sum(CASE WHEN total_spent > 2000000 THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS high_value_percentage
        FROM ({SPENT_BY_STATE}) GROUP BY 1""",
    "transactions customers",
)
def conditional_share(t):
    spent = profiles(t.transactions, "total_spent").join(t.customers.select("customer_id", "state"), "customer_id")
    shares = aggregates.share_above(spent, ["state"], "total_spent", 2_000_000)
    return rounded(shares, avg_spending_per_customer=4, high_value_percentage=6)


@query(
    "ag11_having",
    """SELECT customer_id, round(sum(amount), 2) AS total_spent FROM transactions
       GROUP BY 1 HAVING sum(amount) > 3000000""",
    "transactions",
)
def having(t):
    return t.spark.sql(
        "SELECT customer_id, round(sum(amount), 2) AS total_spent FROM {transactions} "
        "GROUP BY customer_id HAVING sum(amount) > 3000000",
        transactions=t.transactions,
    )


@query(
    "ag12_pivot",
    """SELECT n_name AS state, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS F,
              round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS O,
              round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS P
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def pivot(t):
    per_customer = t.transactions.groupBy("customer_id", "payment_method").agg(F.sum("amount").alias("amount"))
    wide = (
        per_customer.join(t.customers.select("customer_id", "state"), "customer_id")
        .groupBy("state").pivot("payment_method", ["F", "O", "P"]).agg(F.sum("amount"))
    )
    return rounded(wide, F=2, O=2, P=2)


@query(
    "ag13_cube",
    """SELECT category, payment_method, round(sum(amount), 2) AS total_sales, count(*) AS transaction_count
       FROM transactions GROUP BY CUBE (category, payment_method)""",
    "transactions",
)
def cube(t):
    return t.transactions.cube("category", "payment_method").agg(
        r(F.sum("amount")).alias("total_sales"), F.count("*").alias("transaction_count")
    )


@query(
    "ag14_calendar_rollup",
    """SELECT year, quarter, month, round(sum(amount), 2) AS total_sales, count(*) AS transaction_count,
              count(DISTINCT customer_id) AS unique_customers, round(avg(amount), 6) AS avg_transaction_amount,
              CASE grouping(year, quarter, month) WHEN 7 THEN 'Grand Total' WHEN 3 THEN 'Year Total'
                   WHEN 1 THEN 'Quarter Total' ELSE 'Month Detail' END AS aggregation_level
       FROM (SELECT year(transaction_date)::INT AS year, quarter(transaction_date)::INT AS quarter,
                    month(transaction_date)::INT AS month, amount, customer_id FROM transactions)
       GROUP BY ROLLUP (year, quarter, month)""",
    "transactions",
)
def calendar_rollup(t):
    rolled = aggregates.calendar_rollup(t.transactions, "transaction_date", "amount", "customer_id")
    return rounded(rolled, total_sales=2, avg_transaction_amount=6)


@query(
    "ag15_unpivot",
    """SELECT flag, direction, count FROM (
         SELECT l_returnflag AS flag, count(*) FILTER (WHERE l_linestatus = 'F') AS "Departure",
                count(*) FILTER (WHERE l_linestatus = 'O') AS "Arrival" FROM lineitem GROUP BY 1)
       UNPIVOT (count FOR direction IN ("Departure", "Arrival"))""",
)
def unpivot(t):
    wide = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count_if(F.col("l_linestatus") == "F").alias("departure_count"),
        F.count_if(F.col("l_linestatus") == "O").alias("arrival_count"),
    )
    return by_direction(wide, ["flag"], ["departure_count", "arrival_count"])


@query(
    "ag16_two_levels",
    f"SELECT state, round(max(total_spent), 2) AS largest, round(avg(total_spent), 4) AS mean FROM ({SPENT_BY_STATE}) GROUP BY 1",
    "transactions customers",
)
def two_levels(t):
    spent = profiles(t.transactions, "total_spent").join(t.customers.select("customer_id", "state"), "customer_id")
    return spent.groupBy("state").agg(r(F.max("total_spent")).alias("largest"), r(F.avg("total_spent"), 4).alias("mean"))


@query("ag17_dict_style", "SELECT category, round(avg(amount), 6) AS avg_amount FROM transactions GROUP BY 1", "transactions")
def dict_style(t):
    means = t.transactions.groupBy("category").agg({"amount": "avg"}).withColumnRenamed("avg(amount)", "avg_amount")
    return rounded(means, avg_amount=6)


@query(
    "ag18_keyed_sums",
    "SELECT customer_id, round(sum(amount), 2) AS total, round(avg(amount), 6) AS mean FROM transactions GROUP BY 1",
    "transactions",
)
def keyed_sums(t):
    return t.transactions.groupBy("customer_id").agg(r(F.sum("amount")).alias("total"), r(F.avg("amount"), 6).alias("mean"))


@query(
    "ag19_largest_total",
    "SELECT category, round(sum(amount), 2) AS total FROM transactions GROUP BY 1 ORDER BY sum(amount) DESC LIMIT 1",
    "transactions",
)
def largest_total(t):
    return rounded(aggregates.largest_total(t.transactions, "category", "amount"), total=2)


@query(
    "ag20_composite_top",
    """SELECT customer_id, category, round(sum(amount), 2) AS total FROM transactions
       GROUP BY 1, 2 ORDER BY sum(amount) DESC, 1, 2 LIMIT 10""",
    "transactions",
)
def composite_top(t):
    totals = t.transactions.groupBy("customer_id", "category").agg(F.sum("amount").alias("total"))
    return rounded(totals.orderBy(F.desc("total"), "customer_id", "category").limit(10), total=2)


@query(
    "ag21_column_statistics",
    """SELECT count(amount) AS row_count, round(sum(amount), 2) AS total, round(avg(amount), 6) AS mean,
              min(amount) AS smallest, max(amount) AS largest FROM transactions""",
    "transactions",
)
def column_statistics(t):
    return rounded(aggregates.summarise(t.transactions, [], "amount"), total=2, mean=6)


@query(
    "ag22_word_count",
    """SELECT word, count(*) AS count FROM (
         SELECT regexp_replace(lower(unnest(regexp_split_to_array(text, '\\s+'))), '[^a-z]', '', 'g') AS word FROM documents)
       WHERE word <> '' GROUP BY 1""",
)
def word_count(t):
    return aggregates.word_counts(t.wide("documents"), "text")


@query(
    "ag23_exploded_words",
    """SELECT lang, word, count(*) AS uses FROM (
         SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1, 2""",
)
def exploded_words(t):
    exploded = t.wide("documents").select("lang", F.explode(F.split("text", " ")).alias("word"))
    return exploded.groupBy("lang", "word").agg(F.count("*").alias("uses"))


@query(
    "ag24_features_per_key",
    """SELECT customer_id, age, state, count(transaction_id) AS txn_count, round(sum(amount), 2) AS total_spent,
              round(avg(amount), 6) AS avg_transaction, max(amount) AS max_transaction
       FROM transactions JOIN customers USING (customer_id) GROUP BY 1, 2, 3""",
    "transactions customers",
)
def features_per_key(t):
    per_customer = t.transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("txn_count"), r(F.sum("amount")).alias("total_spent"),
        r(F.avg("amount"), 6).alias("avg_transaction"), F.max("amount").alias("max_transaction"),
    )
    return t.customers.select("customer_id", "age", "state").join(per_customer, "customer_id")


PREDICTED = "CASE WHEN (doc_id * 7 + quality) % 10 < 7 THEN quality ELSE 1 - quality END"


def predicted_labels(t):
    return t.labels.select(
        F.col("quality").alias("truth"), F.expr(PREDICTED).cast("int").alias("predicted")
    )


@query(
    "ag25_classification_report",
    f"""WITH p AS (SELECT quality AS truth, {PREDICTED} AS predicted FROM labels),
        c AS (SELECT cls, CASE cls WHEN 0 THEN 'Negative' ELSE 'Positive' END AS label,
                count(*) FILTER (WHERE truth = cls) AS support, count(*) FILTER (WHERE predicted = cls) AS guesses,
                count(*) FILTER (WHERE truth = cls AND predicted = cls) AS hits
              FROM p, (VALUES (0), (1)) AS v(cls) GROUP BY 1),
        s AS (SELECT label, support, hits, hits / guesses AS prec, hits / support AS rec FROM c),
        f AS (SELECT *, 2 * prec * rec / (prec + rec) AS f1 FROM s)
        SELECT label, round(prec, 9) AS precision, round(rec, 9) AS recall, round(f1, 9) AS f1_score, support FROM f
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9),
                         round(sum(hits) / sum(support), 9), sum(support)::BIGINT FROM f
        UNION ALL SELECT 'macro avg', round(avg(prec), 9), round(avg(rec), 9), round(avg(f1), 9), sum(support)::BIGINT FROM f
        UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 9),
                         round(sum(rec * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
                         sum(support)::BIGINT FROM f""",
)
def classification_report(t):
    report = evaluation.classification_report(predicted_labels(t), "truth", "predicted", ["Negative", "Positive"])
    return rounded(report, precision=9, recall=9, f1_score=9)


@query(
    "ag26_confusion_matrix",
    f"""SELECT g.truth, g.predicted, count(p.truth) AS count
        FROM (SELECT * FROM (VALUES (0), (1)) a(truth), (VALUES (0), (1)) b(predicted)) g
        LEFT JOIN (SELECT quality AS truth, {PREDICTED} AS predicted FROM labels) p
          ON g.truth = p.truth AND g.predicted = p.predicted GROUP BY 1, 2""",
)
def confusion_matrix(t):
    return evaluation.confusion_matrix(predicted_labels(t), "truth", "predicted")


def priced_lines(t):
    """Prices with a simple guess from quantity and part."""
    guess = F.col("l_quantity") * (900 + F.col("l_partkey") % 1000)
    return t.lineitem.select("l_suppkey", F.col("l_extendedprice").alias("price"), guess.alias("guess"))


PRICED = "SELECT l_suppkey, l_extendedprice AS price, l_quantity * (900 + l_partkey % 1000) AS guess FROM lineitem"


@query(
    "ag27_regression_metrics",
    f"""SELECT round(sqrt(avg((guess - price) * (guess - price))), 4) AS rmse, round(avg(abs(guess - price)), 4) AS mae,
               round(1 - sum((guess - price) * (guess - price)) / (var_pop(price) * count(price)), 6) AS r2
        FROM ({PRICED})""",
)
def regression_metrics(t):
    return rounded(evaluation.regression_metrics(priced_lines(t), "price", "guess"), rmse=4, mae=4, r2=6)


@query(
    "ag28_error_distribution",
    f"""SELECT l_suppkey, round(avg(e), 4) AS mean_absolute_error, round(stddev_samp(e), 4) AS std_absolute_error,
               round(avg(e / price * 100), 4) AS mean_percentage_error, round(quantile_disc(e, 0.5), 4) AS median_absolute_error,
               round(quantile_disc(e, 0.95), 4) AS p95_absolute_error, count(*) AS total_predictions
        FROM (SELECT l_suppkey, price, abs(guess - price) AS e FROM ({PRICED})) GROUP BY 1""",
)
def error_distribution(t):
    errors = evaluation.with_errors(priced_lines(t), "price", "guess")
    return rounded(
        evaluation.error_distribution(errors, "l_suppkey"),
        mean_absolute_error=4, std_absolute_error=4, mean_percentage_error=4, median_absolute_error=4, p95_absolute_error=4,
    )


@query(
    "so01_union_all",
    "SELECT c_custkey AS key, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier",
)
def union_all(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"))
    return customers.unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind")))


@query(
    "ag29_segment_spread",
    f"""SELECT age_group, spending_tier, count(*) AS customer_count, round(avg(total_spent), 4) AS avg_spending,
               round(stddev_samp(total_spent), 3) AS spending_stddev, round(min(total_spent), 2) AS min_spending,
               round(max(total_spent), 2) AS max_spending, round(quantile_disc(total_spent, 0.25), 2) AS p25_spending,
               round(quantile_disc(total_spent, 0.5), 2) AS median_spending,
               round(quantile_disc(total_spent, 0.75), 2) AS p75_spending, round(quantile_disc(total_spent, 0.95), 2) AS p95_spending,
               round(stddev_samp(total_spent) / avg(total_spent), 6) AS coefficient_of_variation
        FROM (SELECT CASE WHEN age < 25 THEN '18-25' WHEN age < 35 THEN '26-35' WHEN age < 45 THEN '36-45'
                          WHEN age < 55 THEN '46-55' ELSE '55+' END AS age_group,
                     CASE WHEN total_spent > 3000 THEN 'High' WHEN total_spent > 1000 THEN 'Medium' ELSE 'Low' END AS spending_tier,
                     total_spent
              FROM customers JOIN (SELECT customer_id, sum(amount) / 1000 AS total_spent FROM transactions GROUP BY 1)
                USING (customer_id)) GROUP BY 1, 2""",
    "transactions customers",
)
def segment_spread(t):
    totals = t.transactions.groupBy("customer_id").agg((F.sum("amount") / 1000).alias("total_spent"))
    segments = t.customers.join(totals, "customer_id").select(
        tiers.age_group("age").alias("age_group"), tiers.spending_tier("total_spent").alias("spending_tier"), "total_spent"
    )
    spent = F.col("total_spent")
    spread = aggregates.described(
        segments, ["age_group", "spending_tier"], "total_spent",
        {"p25_spending": 0.25, "median_spending": 0.5, "p75_spending": 0.75, "p95_spending": 0.95},
        customer_count=F.count("*"), avg_spending=F.avg(spent), spending_stddev=F.stddev(spent),
        min_spending=F.min(spent), max_spending=F.max(spent),
    )
    return rounded(
        spread.withColumn("coefficient_of_variation", F.try_divide("spending_stddev", "avg_spending")),
        avg_spending=4, spending_stddev=3, min_spending=2, max_spending=2, p25_spending=2, median_spending=2,
        p75_spending=2, p95_spending=2, coefficient_of_variation=6,
    )
