"""Column contracts of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns every month must provide (period, weight, demographics, symptoms, care, work).
CORE_COLUMNS = (
    "ano", "uf", "v1013", "v1022", "v1023", "v1032",
    "a002", "a003", "a004", "a005",
    "b0011", "b0012", "b0014", "b00111",
    "b002", "b006", "b007", "b009b", "b011",
    "c001",
)

# The columns of the bronze catalog table, in file order.
BRONZE_COLUMNS = (
    "Ano", "UF", "CAPITAL", "RM_RIDE", "V1012", "V1013", "V1022", "V1023",
    "A001", "A001A", "A001B1", "A001B2", "A001B3", "A002", "A003", "A004", "A005",
    "B0011", "B0012", "B0013", "B0014", "B0015", "B0016", "B0017", "B0018", "B0019", "B00110", "B00111", "B00112", "B00113",
    "B002", "B0031", "B0032", "B0033", "B0034", "B0035", "B0036", "B0037", "B0041", "B0042", "B0043", "B0044", "B0045", "B0046",
    "B005", "B006", "B007", "B008", "B009A", "B009B", "B009C", "B009D", "B009E", "B009F",
    "B0101", "B0102", "B0103", "B0104", "B0105", "B0106", "B011",
    "C001", "C002", "C003", "C004", "C005", "C0051", "C0052", "C0053", "C006",
    "C007", "C007A", "C007B", "C007C", "C007D", "C007E", "C007E1", "C007E2", "C007F", "C008", "C009", "C010",
    "C0101", "C01011", "C01012", "C0102", "C01021", "C01022", "C0103", "C0104",
    "C011A", "C011A1", "C011A11", "C011A12", "C011A2", "C011A21", "C011A22", "C012", "C013", "C014", "C015", "C016", "C017A",
    "D0011", "D0013", "D0021", "D0023", "D0031", "D0033", "D0041", "D0043", "D0051", "D0053", "D0061", "D0063", "D0071", "D0073",
    "E001", "E0021", "E0022", "E0023", "E0024",
    "F001", "F0021", "F0022", "F002A1", "F002A2", "F002A3", "F002A4", "F002A5",
    "posicao", "estrato", "V1027", "V1028", "V1029", "V1030", "V1031", "V1032",
)

# Directory keys of the bronze and the silver layer.
BRONZE_PERIOD = ("year", "month")
SILVER_PERIOD = ("ano", "v1013")

# Typed silver column -> raw code column.
INT_COLUMNS = {
    "ano_int": "ano",
    "uf_int": "uf",
    "mes_int": "v1013",
    "idade": "a002",
    "sexo": "a003",
    "cor_raca": "a004",
    "febre": "b0011",
    "tosse": "b0012",
    "dif_respirar": "b0014",
    "perda_cheiro": "b00111",
    "procurou_atendimento": "b002",
    "internado": "b006",
    "plano_saude": "b007",
    "fez_teste": "b009b",
    "resultado_teste": "b011",
    "afastou_trabalho": "c001",
}
WEIGHT_COLUMN, WEIGHT_SOURCE = "peso", "v1032"
SYMPTOM_COLUMNS = ("febre", "tosse", "dif_respirar", "perda_cheiro")


def strings(columns) -> T.StructType:
    """A schema of nullable strings, the only type of the bronze layer."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


BRONZE_SCHEMA = strings(BRONZE_COLUMNS)

SILVER_SCHEMA = T.StructType(
    strings(CORE_COLUMNS).fields
    + [T.StructField("uf_nome", T.StringType()), T.StructField("regiao", T.StringType())]
    + [T.StructField("teve_sintomas_covid", T.IntegerType())]
    + [T.StructField(c, T.IntegerType()) for c in INT_COLUMNS]
    + [T.StructField(WEIGHT_COLUMN, T.DoubleType())]
)
