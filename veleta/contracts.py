"""Column contracts of the layers."""

from __future__ import annotations

# Names and types of the columns of each layer.
RAW_FILES = "id long, fuente string, tipo_fuente string, ruta string, registros long, columnas int, bytes long, hash_sha256 string, fecha_carga timestamp, run_id string"
RAW_RECORDS = "id long, raw_file_id long, raw_data string, run_id string"

#: Measures of an observation; counts default to 0, scores to null.
COUNT_MEASURES = ("cantidad_menciones", "cantidad_interacciones", "stars_github", "forks_github", "issues_abiertos", "releases")

#: What every source mapper returns.
OBSERVATION = {
    "id_origen_registro": "string",
    "plataforma": "string",
    "titulo": "string",
    "texto": "string",
    "url": "string",
    "fecha_evento_raw": "string",
    "agente": "string",
    "cantidad_menciones": "long",
    "cantidad_interacciones": "long",
    "score_popularidad": "double",
    "stars_github": "long",
    "forks_github": "long",
    "issues_abiertos": "long",
    "releases": "long",
    "indice_adopcion": "double",
    "indice_innovacion": "double",
    "sentimiento_promedio": "double",
    "tecnologia_raw": "string",
    "comunidad_raw": "string",
    "tipo_comunidad_raw": "string",
    "region_comunidad_raw": "string",
    "fuente": "string",
    "tipo_fuente": "string",
    "raw_file_id": "long",
    "raw_record_id": "long",
    "fecha_carga_raw": "timestamp",
}
#: Columns that classification adds.
CLASSIFIED = {
    "fecha_evento": "date",
    "is_imputed_date": "boolean",
    "nombre_agente": "string",
    "categoria": "string",
    "dim_nombre_plataforma": "string",
    "dim_tipo_plataforma": "string",
    "dim_ecosistema": "string",
    "dim_plataforma_metodo": "string",
    "dim_nombre_tecnologia": "string",
    "dim_categoria_tecnologia": "string",
    "dim_dominio_tecnologico": "string",
    "dim_tecnologia_metodo": "string",
    "dim_tipo_senal": "string",
    "dim_nombre_comunidad": "string",
    "dim_tipo_comunidad": "string",
    "dim_region_comunidad": "string",
    "dim_comunidad_metodo": "string",
}
STAGING = OBSERVATION | CLASSIFIED

#: Widths of text columns in staging.
WIDTHS = {
    "url": 500,
    "dim_nombre_plataforma": 100,
    "dim_tipo_plataforma": 100,
    "dim_ecosistema": 100,
    "dim_nombre_tecnologia": 120,
    "dim_categoria_tecnologia": 100,
    "dim_dominio_tecnologico": 120,
    "dim_tipo_senal": 100,
    "dim_nombre_comunidad": 120,
    "dim_tipo_comunidad": 100,
    "dim_region_comunidad": 100,
}
OUTCOMES = "source string, query string, status string, records_extracted long, execution_timestamp timestamp"
