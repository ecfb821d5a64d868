"""Delivery rows, reports and daily summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..operators.dedup import latest_per_key, top_per_key
from ..operators.joins import attach_group
from ..sources import lookups
from .config import AuditConfig
from .provider_feed import MORE_AUTHORISATIONS

# --- fixed values -----------------------------------------------------------
SAVINGS_MESSAGES = [
    "Contratante con autoseguro vencido",
    "Afiliado no vigente en RS entre las fechas de la carta de garantia",
    "Factura con duplicidad de pago",
    "La cantidad de siteds de CPM en la trama no coincide con RS",
    "CPM cronico con mas de una atencion en un mismo grupo de clinica",
]
EFFECTIVE_MESSAGES = [
    "Sin Carta Garantia en la trama pero si en el sustento",
    "Sin Nota Credito en la trama pero si en el sustento",
    "La fecha de emision de NC y Trama no coinciden",
    "El codigo de autorizacion de la hoja siteds no coincide con el de Liquidacion",
]
REGULAR = "Flujo regular"
# --- end of fixed values ----------------------------------------------------

#: Wide rows that a task joins and compares at once, and up to how many such tasks Spark may lay out as it likes.
TASK_ROWS, FEW_TASKS = 1 << 17, 8

SNAPSHOT = ["bandeja", "des_cobertura", "tip_caso_especial", "proveedor", "sede", "red", "des_producto", "paciente",
            "nom_completo_contratante", "desc_estado", "motivo_notificado"]
REPORT = [
    "bandeja", "num_factura", "ruc_proveedor_emisor_ocr", "fecha_proceso", "num_siniestro", "factura_duplicada", "fec_atencion_duplicado",
    "num_siniestro_factDup", "dsc_dup", "estado_procesado_duplicado", "estado_alerta_IA", "alerta_IA", "monto_factura", "des_producto",
    "paciente", "nom_completo_contratante", "desc_estado", "motivo_notificado", "des_cobertura", "tip_caso_especial", "proveedor", "sede",
    "red", "flag_reglas_ahorro", "time_stamp", "num_lote", "flag_alerta_efectiva",
]


def delivery(alerts: DataFrame, snapshot: DataFrame, headers: DataFrame | None, period: str, group: str | None = None) -> DataFrame:
    """Alerts with the official claim and, for the network, the newest document batch.

    group names the alert column that replaces the snapshot's network (provider list).

    Many wide rows are shuffled once, by invoice and claim, and copies of a row meet there too.  The number of partitions then
    follows the rows, which are counted before: Spark goes by compressed size, which says little of the memory such rows take.
    """
    right = snapshot.select(F.col("factura").alias("__n"), F.col("num_siniestro").alias("__s"), *SNAPSHOT)
    df = alerts.where(F.col("processed_date") == period)
    columns = [*[c for c in df.columns if c != group], *SNAPSHOT]
    if group:
        df = df.where(F.col("reglas_mensaje") != MORE_AUTHORISATIONS).withColumnRenamed(group, "red")
        right = right.drop("red")
    else:
        batches = latest_per_key(headers.select("invoice_number", "batch_name", "processed_date"), ["invoice_number"],
                                 ["processed_date"], ["batch_name"])
        batch = batches.select(F.replace("invoice_number", F.lit("-"), F.lit("")).alias("__i"), F.col("batch_name").alias("num_lote"))
        df = df.join(batch, F.col("num_factura_documento_ocr") == F.col("__i"), "left").drop("__i")
        columns.append("num_lote")
    partitions = max(alerts.count(), snapshot.count()) // TASK_ROWS
    if partitions > FEW_TASKS:
        df = df.repartition(partitions, "num_factura_documento_ocr", "num_siniestro")
        right = right.repartition(partitions, "__n", "__s")
    on = (F.col("num_factura_documento_ocr") == F.col("__n")) & (F.col("num_siniestro") == F.col("__s"))
    df = df.join(right, on, "left")
    return df.select(*columns).withColumns({
        "tip_caso_especial": F.coalesce("tip_caso_especial", F.lit(REGULAR)),
        "flag_ocurrenciaActual": F.when(F.col("bandeja").isNotNull(), 1).otherwise(0),
    }).distinct()


def report_rows(delivered: DataFrame, amount: str, now: Column, effective: bool = True) -> DataFrame:
    """Regular-flow rows with the savings flag; effectiveness only for the network's own alerts."""
    message = F.col("reglas_mensaje")
    judged = F.when(message.isin(EFFECTIVE_MESSAGES), "SI").otherwise("NO") if effective else F.lit(None).cast("string")
    return delivered.where(F.col("tip_caso_especial") == REGULAR).select(
        "*", F.col("num_factura_documento_ocr").alias("num_factura"), F.col("processed_date").alias("fecha_proceso"),
        F.col("estado").alias("estado_alerta_IA"), message.alias("alerta_IA"), F.col(amount).alias("monto_factura"),
        F.when(message.isin(SAVINGS_MESSAGES), 1).otherwise(0).alias("flag_reglas_ahorro"), now.alias("time_stamp"),
        judged.alias("flag_alerta_efectiva")).select(*REPORT)


def provider_report(delivered: DataFrame, now: Column) -> DataFrame:
    """Provider rows that are not OK, one per alert with the highest lot number."""
    rows = report_rows(delivered.where(F.col("estado") != "OK"), "monto_factura_ocr", now, effective=False)
    key = [c for c in REPORT if c not in ("ruc_proveedor_emisor_ocr", "monto_factura", "flag_reglas_ahorro", "time_stamp", "num_lote", "flag_alerta_efectiva")]
    return top_per_key(rows, key, [F.col("num_lote").try_cast("bigint").desc_nulls_last(), F.desc_nulls_last("monto_factura"),
                                   F.asc_nulls_last("ruc_proveedor_emisor_ocr")])


def full_report(network: DataFrame, providers: DataFrame, config: AuditConfig) -> DataFrame:
    """Both reports, networks filled in, and no OK row beside another row of the invoice."""
    both = network.unionByName(providers.where(F.col("tip_caso_especial") == REGULAR))
    return drop_superfluous_ok(fill_network(both, config.network))


def fill_network(df: DataFrame, network: str) -> DataFrame:
    missing = F.col("red").isNull() & F.col("ruc_proveedor_emisor_ocr").isin(lookups.NETWORK_PROVIDERS)
    return df.withColumn("red", F.when(missing, f"RED {network}").otherwise(F.col("red")))


def drop_superfluous_ok(df: DataFrame) -> DataFrame:
    sized = attach_group(df, ["num_factura"], __rows=F.count(F.lit(1)))
    extra = (F.col("estado_alerta_IA") == "OK") & (F.col("__rows") > 1) & F.col("num_factura").isNotNull()
    return sized.where(~F.coalesce(extra, F.lit(False))).drop("__rows")


EXPORT = ["bandeja", "num_factura", "num_siniestro", "factura_duplicada", "fec_atencion_duplicado", "num_siniestro_factDup", "dsc_dup",
          "estado_procesado_duplicado", "estado_alerta_IA", "alerta_IA", "monto_factura", "des_cobertura", "tip_caso_especial", "proveedor",
          "sede", "red", "des_producto", "paciente", "nom_completo_contratante", "desc_estado", "motivo_notificado"]


def export_view(report: DataFrame, period: str) -> DataFrame:
    """Rows of the exported list with their alert class."""
    fine = F.col("estado_alerta_IA") == "OK"
    kind = F.when((F.col("flag_reglas_ahorro") == 1) & ~fine, "Alerta rechazo").when(fine, "No alerta").otherwise("Otras alertas")
    return (report.where(F.col("fecha_proceso") == period)
            .select(*EXPORT, "flag_alerta_efectiva", kind.alias("flag_alerta_rechazo"), "num_lote").distinct())


def provider_export_view(report: DataFrame, period: str, config: AuditConfig) -> DataFrame:
    rows = report.where((F.col("fecha_proceso") == period) & (F.col("estado_alerta_IA") != "OK"))
    red = F.when(F.col("red") == config.network, f"RED {config.network}").otherwise(F.col("red"))
    return rows.withColumn("red", red).withColumn("flag_alerta_efectiva", F.lit(None).cast("string")).select(
        *EXPORT, "flag_alerta_efectiva", "flag_reglas_ahorro", "num_lote").distinct()


def daily_summary(report: DataFrame, period: str, config: AuditConfig, by_network: bool = True, savings_only: bool = False,
                  alias_network: bool = True) -> DataFrame:
    """Counts, amounts and ratios by day (and network): per invoice first, then totals."""
    own = f"RED {config.network}"
    missing = F.col("red").isNull() | (F.col("red") == config.network) if alias_network else F.col("red").isNull()
    keys = ["num_factura", "num_siniestro"]
    observed = F.col("estado_alerta_IA") == "OBSERVADA"
    # the potential of an invoice counts its rows of every period, so one aggregation keeps both apart
    inside = F.col("fecha_proceso") == period
    if savings_only:
        inside = inside & (F.col("flag_reglas_ahorro") == 1)
    rows = report.where(inside | (F.col("flag_reglas_ahorro") == 1))
    amount = F.col("monto_factura")
    per_group = rows.groupBy(
        *keys, F.when(inside, F.col("fecha_proceso")).alias("processed_date"), F.when(inside, F.when(missing, own).otherwise(F.col("red"))).alias("red"),
        F.when(inside, F.col("proveedor")).alias("proveedor"), F.when(inside, F.col("sede")).alias("sede"), F.coalesce(inside, F.lit(False)).alias("inside")).agg(
        F.max(F.when(observed, F.col("num_factura"))).alias("seen"), F.max(F.when(observed, amount)).alias("seen_amount"), F.max(amount).alias("amount"),
        F.max(F.when(F.col("flag_reglas_ahorro") == 1, amount)).alias("potential"))
    # rows without a full key have no potential and are spread
    full = F.col("num_factura").isNotNull() & F.col("num_siniestro").isNotNull()
    of_invoice = Window.partitionBy(*keys, F.when(~full, F.xxhash64("num_factura", "num_siniestro", "proveedor", "sede", "red")))
    joined = per_group.withColumn("monto_potencial", F.when(full, F.max("potential").over(of_invoice))).where("inside")
    group = ["processed_date", "red"] if by_network else ["processed_date"]
    return joined.groupBy(*group).agg(*summary_measures())


def summary_measures() -> list[Column]:
    n, seen = F.count("num_factura"), F.count("seen")
    return [n.alias("ctdFacturas"), F.sum("amount").alias("mtoFacturado"), seen.alias("ctdFactObservadas"),
            F.try_divide(seen, n).alias("pctFactObs"), F.sum("seen_amount").alias("mtoObservado"),
            F.sum("monto_potencial").alias("mtoPotAhorro"),
            F.try_divide(F.sum("monto_potencial"), F.sum("seen_amount")).alias("pctMtoAhorrovsObservador")]


def rejection_by_day(summary: DataFrame, period: str) -> DataFrame:
    """Regrouped by day; the last ratio is observed over savings here, not the reverse."""
    n, seen = F.sum("ctdFacturas"), F.sum("ctdFactObservadas")
    return summary.where(F.col("processed_date") == period).groupBy("processed_date").agg(
        n.alias("ctdFacturas"), F.sum("mtoFacturado").alias("mtoFacturado"), seen.alias("ctdFactObservadas"),
        F.try_divide(seen, n).alias("pctFactObs"), F.sum("mtoObservado").alias("mtoObservado"), F.sum("mtoPotAhorro").alias("mtoPotAhorro"),
        F.try_divide(F.sum("mtoObservado"), F.sum("mtoPotAhorro")).alias("pctMtoAhorrovsObservador"))


def network_extract(summary: DataFrame, period: str, config: AuditConfig) -> DataFrame:
    return summary.where((F.col("processed_date") == period) & (F.col("red") == f"RED {config.network}")).drop("processed_date")


def message_figures(summary: DataFrame, rejection: DataFrame) -> DataFrame:
    """Figures of the daily message: counts as whole numbers, amounts in millions, share in percent."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    first = summary.orderBy(*summary.columns).limit(1).select(
        F.lit(1).alias("__one"), F.col("ctdFacturas").cast("bigint").alias("invoice_number"), money.scaled_text(zero("mtoFacturado")).alias("invoice_amount"),
        F.col("ctdFactObservadas").cast("bigint").alias("invoice_number_obs"),
        F.round(100 * zero("pctFactObs"), 2).alias("invoice_number_obs_percentage"),
        money.scaled_text(zero("mtoObservado")).alias("obs_amount"), money.scaled_text(zero("mtoPotAhorro")).alias("potencial_amount"))
    rejected = rejection.orderBy(*rejection.columns).limit(1).select(
        F.lit(1).alias("__one"), F.col("ctdFacturas").cast("bigint").alias("total_rejected_invoice"),
        money.scaled_text(zero("mtoFacturado")).alias("total_rejected_amount"))
    return first.join(rejected, "__one", "left").drop("__one")
