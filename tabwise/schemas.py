"""Schemas: explicit StructTypes for every scan (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column layouts of the public company registry files and of the
# enrichment sheet. They must equal the published layouts, in this order.
# ---------------------------------------------------------------------------
ESTABLISHMENT_COLUMNS = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_exterior", "pais", "data_inicio_atividades", "cnae_fiscal",
    "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "uf", "municipio", "ddd1", "telefone1",
    "ddd2", "telefone2", "ddd_fax", "fax", "correio_eletronico",
    "situacao_especial", "data_situacao_especial",
]
COMPANY_COLUMNS = [
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social_str", "porte_empresa", "ente_federativo_responsavel",
]
PARTNER_COLUMNS = [
    "cnpj_basico", "identificador_de_socio", "nome_socio", "cnpj_cpf_socio",
    "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
    "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
]
SIMPLE_TAX_COLUMNS = [
    "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
]
CODE_TABLE_COLUMNS = ["codigo", "descricao"]
METADATA_COLUMNS = ["referencia", "valor"]
# Enrichment sheet, 16 columns (the 15-column variant omits "bairro").
SHEET_COLUMNS = [
    "cnpj", "razao_social", "nome_fantasia", "atividade_principal_codigo",
    "atividade_principal_descricao", "situacao_cadastral", "capital_social",
    "porte", "codigo_natureza_juridica", "data_abertura", "bairro", "cep",
    "municipio", "uf", "ddd_telefone_1", "descricao_situacao_cadastral",
]
SHEET_COLUMNS_15 = [c for c in SHEET_COLUMNS if c != "bairro"]
# Registry key width (digits).
KEY_WIDTH = 14
# Code-table file suffixes of the registry extract.
CODE_TABLE_SUFFIXES = {
    "cnae": ".CNAECSV", "motivo": ".MOTICSV", "municipio": ".MUNICCSV",
    "natureza_juridica": ".NATJUCSV", "pais": ".PAISCSV",
    "qualificacao_socio": ".QUALSCSV",
}
# Large-table file suffixes.
LARGE_TABLE_SUFFIXES = {
    "empresas": ".EMPRECSV", "estabelecimento": ".ESTABELE", "socios": ".SOCIOCSV",
    "simples": ".SIMPLES.CSV",
}
# Large-table layouts.
LARGE_TABLE_COLUMNS = {
    "empresas": COMPANY_COLUMNS, "estabelecimento": ESTABLISHMENT_COLUMNS, "socios": PARTNER_COLUMNS,
    "simples": SIMPLE_TAX_COLUMNS,
}
# ---------------------------------------------------------------------------


def all_text_schema(columns: list[str]) -> T.StructType:
    """Every column as nullable text: the layout of a raw delimited extract."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


ESTABLISHMENT_SCHEMA = all_text_schema(ESTABLISHMENT_COLUMNS)
COMPANY_SCHEMA = all_text_schema(COMPANY_COLUMNS)
PARTNER_SCHEMA = all_text_schema(PARTNER_COLUMNS)
SIMPLE_TAX_SCHEMA = all_text_schema(SIMPLE_TAX_COLUMNS)
CODE_TABLE_SCHEMA = all_text_schema(CODE_TABLE_COLUMNS)
METADATA_SCHEMA = all_text_schema(METADATA_COLUMNS)

# Typed sheet: the enrichment output (numbers where the record holds numbers).
SHEET_TYPES = {
    "capital_social": T.DoubleType(),
    "codigo_natureza_juridica": T.LongType(),
}
SHEET_SCHEMA = T.StructType([
    T.StructField(c, SHEET_TYPES.get(c, T.StringType()), True) for c in SHEET_COLUMNS
])

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)
