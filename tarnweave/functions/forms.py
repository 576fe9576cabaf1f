"""Section, label and mode of a notice by the code of its form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Section, label, mode and codes of each form.
FORMS = (
    ("avvisi", "Preinformazione", "preinformazione", "PL1_1 PL1_2 PL1_3 PL1_4 PL1_5 PL1_6 PL1_7 PL1_8 PL1_9 PL2_1 PL2_2 PL2_3 PL2_7 PL2_8 PL2_9"),
    ("bandi", "Bando di gara", "gara", "P1_10 P1_11 P1_12 P1_13 P1_14 P2_10 P2_11 P2_12 P2_13 P2_14"),
    ("avvisi", "Sistema di qualificazione", "qualificazione", "P1_15_1 P1_15_2"),
    ("avvisi", "Indagine di mercato", "indagine", "P7_1_1 P7_1_2 P7_1_3"),
    ("avvisi", "Elenco operatori economici", "elenco", "P7_3"),
    (
        "esiti", "Avviso di aggiudicazione", "gara",
        "A1_29 A1_30 A1_31 A1_32 A1_33 A1_34 A1_35 A1_36 A1_37 A2_29 A2_30 A2_31 A2_32 A2_33 A2_34 A2_35 A2_36 A2_37 A3_4 A3_5 A4_1 A4_2 A4_3 A4_4 A4_5 A4_6 A7_1_2 AD2_25 AD2_26 AD2_27 AD2_28 NAG",
    ),
    ("esiti", "Esito affidamento diretto", "diretto", "AD3"),
    ("avvisi", "Avviso affidamento diretto", "diretto", "A3_6"),
    ("esiti", "Trasparenza preventiva", "trasparenza", "A7_1_1 AD1_25 AD1_26 AD1_27 AD1_28"),
    ("avvisi", "Modifica del contratto", "modifica", "M1 M1_40 M2 M2_40"),
)


def described(rows: DataFrame, code: str) -> DataFrame:
    """Rows with ``section``, ``label`` and ``mode`` of their form.

    An unknown code is its own label, a null or empty one has a dash; both are of section ``?`` and mode ``altro``.
    """
    known = [(x, section, label, mode) for section, label, mode, codes in FORMS for x in codes.split()]
    forms = rows.sparkSession.createDataFrame(known, "_code string, section string, label string, mode string")
    none = F.when(F.coalesce(F.col(code), F.lit("")) == "", "—").otherwise(F.concat(F.lit("Scheda "), F.col(code)))
    joined = rows.join(F.broadcast(forms), F.col(code) == F.col("_code"), "left").drop("_code")
    return joined.withColumns({"section": F.coalesce("section", F.lit("?")), "label": F.coalesce("label", none), "mode": F.coalesce("mode", F.lit("altro"))})
