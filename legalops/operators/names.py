"""The display name of a client, whichever kind of client it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legalops.sources.tables import Tables


def client_names(t: Tables) -> DataFrame:
    """One row per client: id_client, created_at and the first name found of
    entrepreneur, company and person, since a client might be in several."""
    entrepreneur = t["client_entrepreneur"].select("id_client", F.col("fio").alias("_entrepreneur"))
    company = t["client_legal"].select("id_client", F.col("company_name").alias("_company"))
    person = t["client_person"].select("id_client", F.col("fio").alias("_person"))
    return (
        t["client"]
        .select("id_client", "created_at")
        .join(entrepreneur, "id_client", "left")
        .join(company, "id_client", "left")
        .join(person, "id_client", "left")
        .select("id_client", "created_at", F.coalesce("_entrepreneur", "_company", "_person").alias("name"))
    )


def client_payments(t: Tables) -> DataFrame:
    """What each client paid: one row per incoming payment of the client's bundles."""
    bundles = t["payment_bundle"].select("id_payment_bundle", "id_client")
    links = t["income_payment_bundle"].select("id_income_pay_document", "id_payment_bundle")
    incomes = t["income_pay_document"].select("id_income_pay_document", "account_no", "amount", "payment_date")
    return bundles.join(links, "id_payment_bundle").join(incomes, "id_income_pay_document")
