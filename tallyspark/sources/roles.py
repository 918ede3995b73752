"""The domain tables, played by the TPC-H-like test tables.

Every function takes ``(spark, folder)`` and derives one domain table from whole parquet tables. Money becomes decimal
before anything is added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR = 1995

# Declared schemas: reading does not have to open a file to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey)


def _literal(spark: SparkSession, values: str) -> DataFrame:
    """Configuration rows of a test role: a local relation, so its size is known to the planner."""
    return spark.sql(f"SELECT * FROM VALUES {values}")


def period(spark: SparkSession, folder: str) -> DataFrame:
    """Every month in which something was ordered."""
    day = F.col("o_orderdate")
    months = table(spark, folder, "orders").select(F.year(day).alias("y"), F.month(day).alias("m")).distinct()
    return months.select(
        ((F.col("y") - FIRST_YEAR) * 12 + F.col("m")).cast("int").alias("period_id"),
        F.concat(F.lpad(F.col("m").cast("string"), 2, "0"), F.lit("/"), F.col("y").cast("string")).alias("period"),
    )


def period_of(day: Column) -> Column:
    return ((F.year(day) - FIRST_YEAR) * 12 + F.month(day)).cast("int")


def balance_history(spark: SparkSession, folder: str) -> DataFrame:
    return _order_lines(spark, folder).select(
        F.col("o_custkey").alias("account_id"),
        F.col("l_returnflag").alias("fund_id"),
        F.col("l_linestatus").alias("subaccount_id"),
        F.col("o_orderdate").alias("settled_at"),
        F.col("l_quantity").cast("decimal(18,6)").alias("units"),
    )


def subaccount_type(spark: SparkSession, folder: str) -> DataFrame:
    return _literal(spark, "('F', 1, 'RCV 92'), ('O', 2, 'VIV 97') AS t(subaccount_id, regime_id, label)")


def share_price(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.col("l_returnflag").alias("fund_id"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("regime_id"),
            F.to_date("l_shipdate").alias("price_date"),
        )
        .agg(F.max(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"))
    )


def movement(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _order_lines(spark, folder).select(
        F.col("o_custkey").alias("account_id"),
        F.when(flag == "A", 180).when(flag == "R", 181).otherwise(182).alias("type_id"),
        F.col("l_linenumber").alias("concept_id"),
        F.col("l_linestatus").alias("subaccount_id"),
        flag.alias("fund_id"),
        F.col("l_orderkey").alias("folio"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").alias("settled_at"),
        F.col("l_linenumber").alias("family"),
    )


def commission_src(spark: SparkSession, folder: str) -> DataFrame:
    return _order_lines(spark, folder).select(
        F.col("o_custkey").alias("account_id"),
        F.col("l_linenumber").alias("concept_id"),
        F.col("l_shipdate").alias("settled_at"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(6,2)")).alias("amount"),
    )


def concept_config(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"({n}, {n + 500})" for n in range(1, 8))
    return _literal(spark, f"{values} AS t(concept_id, mov_subacc_id)")


def concept_subaccount(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"({n + 500}, '{'F' if n <= 3 else 'O'}')" for n in range(1, 8))
    return _literal(spark, f"{values} AS t(mov_subacc_id, subaccount_id)")


def concept_bridge(spark: SparkSession, folder: str) -> DataFrame:
    values = "(1, 101), (2, 101), (3, 102), (4, 102), (5, 103), (6, 104), (7, 104)"
    return _literal(spark, f"{values} AS t(concept_id, regulator_id)")


def regulator_concept(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "(101, 'APORTACION', 'AHO'), (102, 'RETIRO', 'AHO'), (103, 'TRASPASO', 'VIV'), (104, 'AJUSTE', 'VIV')"
    )
    return _literal(spark, f"{values} AS t(regulator_id, description, section)")


def fund(spark: SparkSession, folder: str) -> DataFrame:
    return _literal(spark, "('A', 'BASICA A'), ('N', 'BASICA N'), ('R', 'BASICA R') AS t(fund_id, description)")


def sample_quota(spark: SparkSession, folder: str) -> DataFrame:
    values = "(101, 5, true), (102, 3, true), (103, 4, true), (104, 2, true)"
    return _literal(spark, f"{values} AS t(regulator_id, quantity, active)")


def account_indicator(spark: SparkSession, folder: str) -> DataFrame:
    kind, event = F.col("event_type"), F.col("event_id")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("account_id"),
        event,
        F.when(kind == "view", 1).when(kind == "click", 12).when(kind == "purchase", 11).when(kind == "signup", 2)
        .otherwise(99).alias("indicator_id"),
        F.when(kind == "view", 66 + event % 4).when(kind == "click", 713 + event % 2).otherwise(event % 2)
        .cast("string").alias("code"),
        F.when(event % 10 == 0, 0).otherwise(1).alias("valid"),
    )


def indicator_config(spark: SparkSession, folder: str) -> DataFrame:
    return _literal(spark, "(1), (2), (11), (12) AS t(indicator_id)")


def client(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("contract_number"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
        )
    )


def movement_wide(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    zero = F.lit(0).cast("decimal(18,2)")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("folio"),
        F.col("l_linenumber").alias("code"),
        F.col("l_suppkey").cast("int").alias("fund_id"),
        F.when(flag.isin("A", "N"), F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(zero).alias("slot_1"),
        F.when(flag.isin("R", "N"), F.col("l_quantity").cast("decimal(18,2)")).otherwise(zero).alias("slot_3"),
    )


def switch(spark: SparkSession, folder: str) -> DataFrame:
    values = "(1, 1, 11, 1), (1, 3, 13, 2), (2, 1, 21, 3), (3, 3, 33, 4), (9, 1, 91, 5)"
    return _literal(spark, f"{values} AS t(code, slot, subaccount_id, ordinal)")

# --- clients -----------------------------------------------------------------------------------
SECOND_CONTRACT = 10_000_000


def contract(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and suppliers are contracts; both number them alike, so some accounts have two."""
    line = F.when(F.col("segment") == "FURNITURE", 764).otherwise(763).alias("line_id")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("contract_id"),
        F.col("c_name").alias("contract_number"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + SECOND_CONTRACT).alias("contract_id"),
        F.col("s_name").alias("contract_number"),
        F.lit("SUPPLIER").alias("segment"),
    )
    return customers.unionByName(suppliers).select("contract_id", "contract_number", line)


def contract_role(spark: SparkSession, folder: str) -> DataFrame:
    role = F.when(F.col("balance") < -900, 788).otherwise(787).alias("role_id")
    return _parties(spark, folder).select(
        F.col("party_id").alias("contract_id"), F.col("party_id").alias("person_id"), role
    )


def _parties(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + SECOND_CONTRACT).alias("party_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"), F.col("s_acctbal").alias("balance"),
        F.lit(None).cast("string").alias("segment"),
    )
    return customers.unionByName(suppliers)


def person(spark: SparkSession, folder: str) -> DataFrame:
    return _parties(spark, folder).select(
        F.col("party_id").alias("person_id"),
        F.col("name").alias("first_name"),
        F.col("segment").alias("paternal_name"),
        F.when(F.col("balance") > 0, F.lit("POSITIVE")).alias("maternal_name"),
    )


def home(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("nation_id") == 24, 819).otherwise(818).alias("home_type")
    return _parties(spark, folder).select(
        F.col("party_id").alias("person_id"), F.col("party_id").alias("address_id"), kind
    )


def address(spark: SparkSession, folder: str) -> DataFrame:
    return _parties(spark, folder).select(
        F.col("party_id").alias("address_id"),
        F.concat(F.lit("STREET "), F.col("nation_id").cast("string")).alias("street"),
        F.col("party_id").cast("string").alias("street_number"),
        F.col("nation_id").alias("zip_id"),
        F.when(F.col("nation_id") < 5, F.col("nation_id")).alias("settlement_id"),
    )


def zip_code(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        key.alias("zip_id"), (key + 10000).cast("string").alias("zip"), key.alias("state_id"),
        F.col("n_regionkey").alias("municipality_id"),
    )


def state(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("state_id"), F.col("n_name").alias("name"))


def municipality(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").alias("municipality_id"), F.col("r_name").alias("name")
    )


def settlement(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").alias("settlement_id"), F.concat(F.lit("COL "), F.col("r_name")).alias("name")
    )


def identifier(spark: SparkSession, folder: str) -> DataFrame:
    """Three identifiers per person; some are not valid or not active."""
    balance = F.col("balance")
    entries = F.array(
        *(
            F.struct(
                F.lit(type_id).alias("type_id"),
                F.concat(F.lit(prefix), F.col("party_id").cast("string")).alias("value"),
                valid.cast("int").alias("is_valid"),
                active.cast("int").alias("is_active"),
            )
            for type_id, prefix, valid, active in (
                (1, "RFC", balance > 0, F.lit(True)),
                (2, "CURP", F.lit(True), balance > 1000),
                (3, "NSS", F.lit(True), F.lit(True)),
            )
        )
    )
    return _parties(spark, folder).select(F.col("party_id").alias("person_id"), F.inline(entries))


def payment(spark: SparkSession, folder: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderkey").alias("folio"),
        F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias("settlement_folio"),
        F.when(priority == "1-URGENT", 4050).when(priority == "2-HIGH", 4051).otherwise(4045).alias("process_id"),
        F.when(status == "F", 309).when(status == "P", 310).otherwise(311).alias("subprocess_id"),
        F.when(status == "F", 1).otherwise(2).alias("pay_type_id"),
        F.when(priority == "1-URGENT", "40012").when(priority == "2-HIGH", "40014").otherwise("NA").alias("bank"),
        F.round(F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(4,2)"), 2)
        .cast("decimal(18,2)").alias("tax"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("settled_at"),
    )


def payment_subaccount(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("folio"),
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("settlement_folio"),
        (F.col("l_linenumber") + 12).alias("subaccount_id"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "(1, 'TRANSFERENCIA', 'Transfer'), (2, 'CHEQUE', 'Check'), (309, 'JUBILACION', 'Retirement'), "
        "(310, 'INVALIDEZ', 'Disability'), (700, 'G0', 'Perfil 0'), (701, 'G1', 'Perfil 1'), (702, 'G2', 'Perfil 2'), "
        "(703, 'G3', 'Perfil 3'), (40012, 'BANCO UNO', 'First bank'), (40014, 'BANCO DOS', 'Second bank')"
    )
    return _literal(spark, f"{values} AS t(catalog_id, value, description)")


def investment_group(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("account_id"), (F.col("n_regionkey") + 700).alias("group_id")
    )


def manual_upload(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.when(segment == "BUILDING", "MM").otherwise("IND").alias("procedure"),
        F.when(F.col("c_acctbal") > 9000, 1).otherwise(2).alias("area_id"),
        F.lit(39).alias("period_id"),
    )


# --- legacy movements --------------------------------------------------------------------------
def legacy_wide(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    zero = F.lit(0).cast("decimal(18,2)")
    return table(spark, folder, "lineitem").select(
        (F.col("l_partkey") + 6_999_999_000).alias("account_id"),
        F.col("l_orderkey").alias("folio"),
        (F.col("l_linenumber") + 110).alias("code"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("booked"),
        F.col("l_suppkey").cast("int").alias("fund_id"),
        F.when(flag == "R", "INT. RET08").when(flag == "A", "INT. CYVTRA").otherwise("OTHER").alias("employer_tag"),
        F.when(flag.isin("A", "N"), F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(zero).alias("slot_1"),
        F.when(flag.isin("R", "N"), F.col("l_quantity").cast("decimal(18,2)")).otherwise(zero).alias("slot_3"),
    )


def legacy_switch(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "(111, 1, 11, 1), (111, 3, 13, 2), (112, 1, 21, 3), (113, 3, 33, 4), (117, 1, 71, 5), (117, 3, 73, 6), "
        "(117, 5, 75, 7)"
    )
    return _literal(spark, f"{values} AS t(code, slot, subaccount_id, ordinal)")


def contribution(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("account_id"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("transferred"),
        F.col("l_linenumber").alias("correlative"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("base_salary"),
        F.col("l_orderkey").alias("folio"),
        F.col("l_shipdate").alias("shipped"),
    )


# --- statements --------------------------------------------------------------------------------
def statement_format(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(
        f"({10 * generation + number}, {generation}, 1, {front}, {back}, {origin}, {affiliation}, {active})"
        for generation in (2, 3)
        for number, (front, back, origin, affiliation, active) in enumerate(
            [(3, 4, 1, 5, "true"), (3, 1, 2, 6, "true"), (2, 2, 3, 5, "true"), (4, 3, 4, 6, "true"),
             (1, 1, 1, 7, "true"), (1, 1, 2, 5, "false"), (2, 2, 1, 6, "true")]
        )
    )
    return _literal(
        spark,
        f"{values} AS t(format_id, generation_id, generation_periodicity_id, front_periodicity_id, "
        "back_periodicity_id, origin_indicator_id, affiliation_indicator_id, active)",
    )


def periodicity(spark: SparkSession, folder: str) -> DataFrame:
    return _literal(spark, "(1, 1), (2, 2), (3, 3), (4, 12) AS t(periodicity_id, months)")


def format_indicator(spark: SparkSession, folder: str) -> DataFrame:
    values = "(1, 66), (2, 67), (3, 68), (4, 69), (5, 713), (6, 714), (7, 1)"
    return _literal(spark, f"{values} AS t(indicator_id, value)")


def front_line(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "(2, 'RETIRO', 'AHORRO PARA EL RETIRO', 'AHO', array('F')), "
        "(2, 'TOTAL', 'TODAS LAS SUBCUENTAS', 'TOT', array('F', 'O')), "
        "(3, 'VIVIENDA', 'AHORRO PARA VIVIENDA', 'VIV', array('O')), "
        "(3, 'RETIRO', 'AHORRO PARA EL RETIRO', 'AHO', array('F', 'O')), "
        "(3, 'VOLUNTARIO', 'AHORRO VOLUNTARIO', 'AHO', array('X'))"
    )
    return _literal(spark, f"{values} AS t(generation_id, savings_type, concept, section, subaccounts)")


def dated_movement(spark: SparkSession, folder: str) -> DataFrame:
    """Movements with the period of their date."""
    return movement(spark, folder).withColumn("period_id", period_of(F.col("settled_at")))


def return_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly measures per account and sub-account. Narrow decimals add up as longs."""
    price = F.col("l_extendedprice").cast("decimal(8,2)")
    quantity = F.col("l_quantity").cast("decimal(8,2)")
    flag = F.col("l_returnflag")
    zero = F.lit(0).cast("decimal(8,2)")

    def total(value, name):
        return F.sum(value).cast("decimal(18,4)").alias(name)

    return (
        _order_lines(spark, folder)
        .groupBy(
            F.col("o_custkey").alias("account_id"),
            period_of(F.col("l_shipdate")).alias("period_id"),
            F.col("l_linestatus").alias("subaccount_id"),
        )
        .agg(
            total(quantity, "initial"),
            total(price, "final"),
            total(F.when(flag == "A", price).otherwise(zero), "credit"),
            total(F.when(flag == "R", price).otherwise(zero), "charge"),
            total(price * F.col("l_tax").cast("decimal(6,2)"), "commission"),
        )
    )


# --- withdrawals -------------------------------------------------------------------------------
def settled_request(spark: SparkSession, folder: str, historic: bool) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    chosen = status == "P" if historic else status != "P"
    return table(spark, folder, "orders").filter(chosen).select(
        F.col("o_orderkey").alias("folio"),
        F.col("o_custkey").alias("account_id"),
        F.when(priority == "5-LOW", 4060).when(priority == "1-URGENT", 4050).otherwise(4045).alias("process_id"),
        F.when(status == "F", 309).otherwise(310).alias("subprocess_id"),
        F.when(status == "O", 6600).otherwise(6649).alias("status_id"),
        F.when(F.col("o_totalprice") > 450000, "0").otherwise("1").alias("grouped"),
        F.col("o_orderdate").alias("created_at"),
    )


def withdrawal_movement(spark: SparkSession, folder: str) -> DataFrame:
    """Movements dated like their order, so that folio and movement meet in one period."""
    return _order_lines(spark, folder).select(
        F.col("l_orderkey").alias("folio"),
        (F.col("l_linenumber") + 12).alias("subaccount_id"),
        F.col("l_returnflag").alias("fund_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("settled_at"),
    )


def withdrawal_history(spark: SparkSession, folder: str) -> DataFrame:
    return _order_lines(spark, folder).select(
        F.col("o_custkey").alias("account_id"),
        F.col("l_returnflag").alias("fund_id"),
        (F.col("l_linenumber") + 12).alias("subaccount_id"),
        F.col("o_orderdate").alias("settled_at"),
        F.col("l_quantity").cast("decimal(18,6)").alias("units"),
    )


def withdrawal_subaccount(spark: SparkSession, folder: str) -> DataFrame:
    values = "(13, 1), (14, 2), (15, 2), (16, 2), (17, 1), (18, 1), (19, 1)"
    return _literal(spark, f"{values} AS t(subaccount_id, regime_id)")


def _procedure_code():
    return F.substring("o_orderpriority", 1, 1).cast("int")


def procedure(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("folio"),
        _procedure_code().alias("procedure_type"),
        F.col("o_orderpriority").alias("benefit_type"),
        F.lit("73").alias("regime_code"),
    )


def transfer(spark: SparkSession, folder: str, historic: bool) -> DataFrame:
    """Current transfers have a code that the map does not know; historic ones are known."""
    code = _procedure_code()
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("folio"),
        (code if historic else code + 2).alias("procedure_type"),
        F.lit("HIST" if historic else "CUR").alias("transfer_regime"),
    )


def procedure_map(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "(1, 'T97', 11, 'Trabajador 97'), (2, 'TRU', 12, 'Trabajador RU'), (3, 'XXX', 13, 'Otro'), "
        "(4, 'TNP', 14, 'Negativa')"
    )
    return _literal(spark, f"{values} AS t(new_code, legacy_description, legacy_code, new_description)")


# --- run log and notifications -----------------------------------------------------------------
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    seconds = F.floor(F.col("value") * 60).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("phase_id"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("ended_at"),
        (F.col("event_type") == "error").alias("failed"),
    )


def phase(spark: SparkSession, folder: str) -> DataFrame:
    values = (
        "('view', '00:05', '00:15'), ('click', '00:10', '00:30'), ('purchase', '00:20', '01:00'), "
        "('error', '00:01', '00:02')"
    )
    return _literal(spark, f"{values} AS t(phase_id, green, yellow)")


def concept(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions of movement concepts."""
    values = ", ".join(f"({n}, 'CONCEPTO {n}')" for n in range(1, 8))
    return _literal(spark, f"{values} AS t(concept_id, description)")


# --- catalogs ----------------------------------------------------------------------------------
def fund_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("fund_id"))


def supplier_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("catalog_id"), F.col("s_name").alias("value")
    )


def subaccount_source(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("subaccount_id"), size.alias("regime_id"), size.cast("bigint").alias("category_id")
    )


def concept_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("concept_id"),
        F.col("p_partkey").alias("mov_subacc_id"),
        F.when(F.col("p_brand") != "Brand#1", 3).alias("slot"),
        (F.col("p_size") + 400).alias("legacy_code"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("legacy_description"),
    )


def concept_subaccount_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("mov_subacc_id"), F.col("p_size").alias("subaccount_id")
    )
