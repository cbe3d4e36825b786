"""Schemas of the files we read and write, and their names and values in our vocabulary.

Files keep the interchange names; DataFrames inside the library use ours.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the interchange files -> our column names.
EVENT_COLUMNS = {
    "event_id": "event_id",
    "event_type": "kind",
    "credit_id": "credit_id",
    "client_id": "client_id",
    "date_evenement": "event_date",
    "montant_fcfa": "amount",
    "statut": "due_status",
}
EVENT_PARTITION_COLUMNS = {"pays_code": "country_code", "annee": "year", "mois": "month"}
CLIENT_COLUMNS = {
    "client_id": "client_id",
    "pays": "country",
    "type_client": "client_type",
    "age_ou_anciennete_entreprise_ans": "age_years",
    "anciennete_bancaire_mois": "bank_tenure_months",
    "revenu_mensuel_fcfa": "monthly_income",
}
CREDIT_COLUMNS = {
    "credit_id": "credit_id",
    "client_id": "client_id",
    "type_credit": "credit_type",
    "montant_initial_fcfa": "principal",
    "duree_mois": "term_months",
    "taux_interet_annuel_pct": "annual_rate_pct",
    "mois_octroi_relatif": "grant_month",
}
PANEL_COLUMNS = {
    "credit_id": "credit_id",
    "client_id": "client_id",
    "mois_relatif": "month_index",
    "dpd_jours": "dpd",
    "stage_ifrs9": "stage",
    "solde_restant_du_fcfa": "outstanding",
    "depassement_decouvert_fcfa": "overdraft_amount",
    "date_releve": "statement_date",
}
LABEL_COLUMNS = {
    "credit_id": "credit_id",
    "client_id": "client_id",
    "mois_relatif": "month_index",
    "date_releve": "statement_date",
    "stage_ifrs9": "stage",
    "bascule_defaut_3m": "default_within_3",
}
FEATURE_COLUMNS = {
    "credit_id": "credit_id",
    "annee_mois": "period",
    "statut_echeance": "due_status",
    "retards_consecutifs": "late_streak",
    "solde_compte_fcfa": "balance",
    "solde_moyen_3m_fcfa": "balance_avg_3",
    "solde_moyen_6m_fcfa": "balance_avg_6",
    "solde_moyen_12m_fcfa": "balance_avg_12",
    "ratio_utilisation_decouvert_3m": "overdraft_ratio_3",
    "frequence_incidents_6m": "incident_freq_6",
}
SUMMARY_COLUMNS = {
    "pays": "country",
    "annee_mois": "period",
    "nb_credits": "n_credits",
    "taux_incidents_moyen": "avg_incident_freq",
    "retards_consecutifs_moyen": "avg_late_streak",
    "ratio_decouvert_moyen": "avg_overdraft_ratio",
}
PREDICTION_COLUMNS = {
    "credit_id": "credit_id",
    "annee_mois": "period",
    "bascule_defaut_3m": "default_within_3",
    "proba_positif": "probability_positive",
    "prediction": "prediction",
}
METRIC_COLUMNS = {
    "auc_roc": "auc_roc",
    "auc_pr": "auc_pr",
    "precision_classe_positive": "precision_positive",
    "rappel_classe_positive": "recall_positive",
    "f1_classe_positive": "f1_positive",
}

# Category values of the interchange files -> our values.
EVENT_KINDS = {
    "echeance_credit": "instalment",
    "mouvement_compte": "movement",
    "depassement_decouvert": "overdraft",
    "consultation_agence": "enquiry",
}
DUE_STATUSES = {
    "paye_a_temps": "on_time",
    "paye_en_retard": "late",
    "impaye": "unpaid",
}

# Countries and their ISO codes.
COUNTRIES = [
    ("Côte d'Ivoire", "CI"),
    ("Bénin", "BJ"),
    ("Burkina Faso", "BF"),
    ("Mali", "ML"),
    ("Niger", "NE"),
    ("Sénégal", "SN"),
    ("Guinée-Bissau", "GW"),
    ("Togo", "TG"),
]

# Names of the tables below a portfolio folder.
LAYOUT = {
    "clients": "clients.csv",
    "credits": "credits.csv",
    "panel": "panel_mensuel.csv",
    "labels": "labels.csv",
    "features": "features",
    "summary": "analyse_risque_pays",
    "predictions": "predictions_test",
    "metrics": "metriques_modele",
    "model": "model",
}

#: Months of the stored window states, a table of our own.
STATE_FOLDER = "as_of"
FEATURE_FOLDER = "annee_mois"

# Interchange schemas, in the column order of the files.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("credit_id", T.StringType(), False),
        T.StructField("client_id", T.StringType(), False),
        T.StructField("date_evenement", T.StringType(), False),
        T.StructField("montant_fcfa", T.DoubleType(), False),
        T.StructField("statut", T.StringType(), True),
    ]
)
CLIENTS = (
    "client_id string, pays string, type_client string, age_ou_anciennete_entreprise_ans int, "
    "anciennete_bancaire_mois int, revenu_mensuel_fcfa double"
)
CREDITS = (
    "credit_id string, client_id string, type_credit string, montant_initial_fcfa double, "
    "duree_mois int, taux_interet_annuel_pct double, mois_octroi_relatif int"
)
PANEL = (
    "credit_id string, client_id string, mois_relatif int, dpd_jours int, stage_ifrs9 int, "
    "solde_restant_du_fcfa double, depassement_decouvert_fcfa double, date_releve date"
)
FEATURES = (
    "credit_id string, annee_mois string, statut_echeance string, retards_consecutifs bigint, "
    "solde_compte_fcfa double, solde_moyen_3m_fcfa double, solde_moyen_6m_fcfa double, "
    "solde_moyen_12m_fcfa double, ratio_utilisation_decouvert_3m double, frequence_incidents_6m double"
)
SUMMARY = (
    "pays string, annee_mois string, nb_credits bigint, taux_incidents_moyen double, "
    "retards_consecutifs_moyen double, ratio_decouvert_moyen double"
)
PREDICTIONS = (
    "credit_id string, annee_mois string, bascule_defaut_3m int, proba_positif double, prediction double"
)
METRICS = ", ".join(f"{name} double" for name in METRIC_COLUMNS)


def label_columns(horizon: int = 3) -> dict[str, str]:
    """Label columns for another horizon than three months."""
    keys = {theirs: ours for theirs, ours in LABEL_COLUMNS.items() if ours != "default_within_3"}
    return {**keys, f"bascule_defaut_{horizon}m": f"default_within_{horizon}"}


def label_schema(horizon: int = 3) -> str:
    return (
        "credit_id string, client_id string, mois_relatif int, date_releve date, stage_ifrs9 int, "
        f"bascule_defaut_{horizon}m int"
    )
