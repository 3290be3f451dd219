"""Fixed vocabulary of the fuel-price survey files.

Fixed values: these must equal the source system's layout and domains for
results to be right. They are stated plainly and in their natural order.
"""

# Raw CSV headers, in file order, with the silver column name.
BRONZE_HEADER_MAP = [
    ("Regiao - Sigla", "regiao_sigla"),
    ("Estado - Sigla", "estado_sigla"),
    ("Municipio", "municipio"),
    ("Revenda", "revenda"),
    ("CNPJ da Revenda", "cnpj_revenda"),
    ("Nome da Rua", "nome_rua"),
    ("Numero Rua", "numero_rua"),
    ("Complemento", "complemento"),
    ("Bairro", "bairro"),
    ("Cep", "cep"),
    ("Produto", "produto"),
    ("Data da Coleta", "data_coleta"),
    ("Valor de Venda", "valor_venda"),
    ("Valor de Compra", "valor_compra"),
    ("Unidade de Medida", "unidade_medida"),
    ("Bandeira", "bandeira"),
]

# The 27 federative units accepted by the state expectation.
VALID_STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# Accepted units of measure.
VALID_UNITS = ["R$ / m³", "R$ / m3", "R$ / litro"]

# Accepted region codes.
VALID_REGIONS = ["S", "SE", "CO", "NE", "N"]

# Declared product domain (an optional expectation).
VALID_PRODUCTS = [
    "GASOLINA ADITIVADA",
    "ETANOL",
    "GASOLINA",
    "DIESEL",
    "GNV",
    "DIESEL S10",
    "DIESEL S50",
]

# Label given to stations without a brand in the share reports.
UNBRANDED_LABEL = "BRANCA"

BRONZE_HEADERS = [h for h, _ in BRONZE_HEADER_MAP]
SILVER_SOURCE_COLUMNS = [s for _, s in BRONZE_HEADER_MAP]

# Silver text columns cleaned with upper(trim(x)); numero_rua is trim only,
# CNPJ and CEP keep digits only.
UPPER_TRIM_COLUMNS = [
    "regiao_sigla", "estado_sigla", "municipio", "revenda", "nome_rua",
    "complemento", "bairro", "produto", "unidade_medida", "bandeira",
]
DIGIT_COLUMNS = ["cnpj_revenda", "cep"]
TRIM_ONLY_COLUMNS = ["numero_rua"]

SILVER_COLUMNS = [
    "filename", "row_hash", "regiao_sigla", "estado_sigla", "municipio",
    "revenda", "cnpj_revenda", "nome_rua", "numero_rua", "complemento",
    "bairro", "cep", "produto", "data_coleta", "valor_venda", "valor_compra",
    "unidade_medida", "bandeira", "ano", "mes",
]

SILVER_TEXT_COLUMNS = [
    "regiao_sigla", "estado_sigla", "municipio", "revenda", "cnpj_revenda",
    "nome_rua", "numero_rua", "complemento", "bairro", "cep", "produto",
    "unidade_medida", "bandeira",
]

POSTO_ATTRIBUTES = [
    "cnpj_revenda", "revenda", "bandeira", "nome_rua", "numero_rua",
    "complemento", "bairro", "cep",
]
