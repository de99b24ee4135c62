"""Relations of a documentation corpus, derived from the driver's tables in SQL that Spark and DuckDB share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_TYPED = """
  SELECT p_partkey AS ord, 'Acme.' || replace(p_brand, '#', '') AS assembly, 'Acme.' || replace(p_brand, '#', '') || '.Core' AS namespace,
         'I' || substr(p_type, 1, 1) || lower(substr(p_type, 2)) AS type_name, replace(p_name, ' ', '') AS member, p_size AS size,
         substr(md5(CAST(p_partkey AS STRING)), 1, 8) AS mark
  FROM {part}"""

BASE = {
    # One page file name of each kind, from parts.
    "files": f"""SELECT ord, CASE ord % 9
         WHEN 0 THEN assembly || '~' || namespace || '.' || type_name || '.html'
         WHEN 1 THEN assembly || '~' || namespace || '.' || type_name || '~' || member || '.html'
         WHEN 2 THEN assembly || '~' || namespace || '.' || type_name || '_members_' || mark || '.html'
         WHEN 3 THEN assembly || '~' || namespace || '_namespace_' || mark || '.html'
         WHEN 4 THEN assembly || '~' || namespace || '.' || member || '_e_' || mark || '_' || mark || '.htmll.html'
         WHEN 5 THEN assembly || '~' || namespace || '.' || type_name || '_' || mark || '.html'
         WHEN 6 THEN 'FunctionalCategories-' || assembly || '~' || member || '.html'
         WHEN 7 THEN assembly || '~' || type_name || '_' || mark || '.html'
         ELSE 'Guide_' || member || '.htm' END AS file_name FROM ({_TYPED}) t""",
    # Links of pages: to types, members, guide pages, other sites.
    "links": f"""SELECT ord, member AS text, CASE ord % 9
         WHEN 0 THEN assembly || '~' || namespace || '.' || type_name || '~' || member || '.html'
         WHEN 1 THEN '../reference/' || assembly || '~' || namespace || '.' || type_name || '.html'
         WHEN 2 THEN namespace || '.' || type_name || '.htm'
         WHEN 3 THEN '../guide//Overview/' || member || '.htm'
         WHEN 4 THEN 'https://www.example.org/x/' || assembly || '~' || namespace || '.' || type_name || '.html'
         WHEN 5 THEN '#' || member
         WHEN 6 THEN 'mailto:' || member || '@example.org'
         WHEN 7 THEN 'https://docs.example.com/help/api/guide/' || member || '.htm?id=' || CAST(size AS STRING)
         ELSE member || '_Example_' || CASE WHEN size % 4 = 0 THEN 'VB' WHEN size % 4 = 1 THEN 'VBNET' WHEN size % 4 = 2 THEN 'CSharp' ELSE 'Other' END || '.htm' END AS href
       FROM ({_TYPED}) t""",
    # Members with signatures; names repeat, as overloads do.
    "members": f"""SELECT ord, assembly, namespace, type_name, namespace || '.' || type_name AS fqn, member,
         CASE WHEN size % 2 = 0 THEN 'property' ELSE 'method' END AS kind,
         '/help/api/reference/' || assembly || '~' || namespace || '.' || type_name || '~' || member || CASE WHEN size % 11 = 0 THEN '.htm' ELSE '.html' END AS url, size
       FROM ({_TYPED}) t""",
    "details": f"""SELECT ord, namespace || '.' || type_name AS fqn, CASE WHEN size % 10 = 9 THEN member || 'X' ELSE member END AS member,
         CASE WHEN size % 5 = 0 THEN '' ELSE 'About ' || member || ' ' || CAST(ord AS STRING) END AS description,
         CASE WHEN size % 2 = 0 THEN member || ' {{{{get;}}}}' ELSE member || '( System.string a' || CASE WHEN size % 3 = 0 THEN ', out System.int b' ELSE '' END || CASE WHEN size % 7 = 0 THEN ', Acme.List<System.int,X> c' ELSE '' END || ' )' END AS signature,
         CASE WHEN size % 2 = 0 THEN '' ELSE 'a|b|c' END AS params,
         CASE WHEN size % 3 = 1 THEN 'Value ' || CAST(size AS STRING) ELSE '' END AS returns,
         CASE WHEN size % 4 = 1 THEN 'See <see cref="' || namespace || '.' || type_name || '">' || type_name || '</see>' WHEN size % 4 = 3 THEN 'Where a & b > ' || CAST(size AS STRING) ELSE '' END AS remarks, size
       FROM ({_TYPED}) t""",
    # Descriptions of types, enumerations, categories; names differ in some rows, so that there are misses on both sides.
    "types": f"""SELECT min(ord) AS ord, max(assembly) AS assembly, namespace || '.' || type_name AS fqn, max(namespace) AS namespace, max(type_name) AS type_name,
         CASE WHEN count(*) % 3 = 0 THEN '' ELSE 'Type ' || max(type_name) || ' of ' || max(namespace) || ' with a description that is long enough to be cut somewhere, at item ' || CAST(min(ord) AS STRING) END AS description,
         CASE WHEN count(*) % 2 = 0 THEN '' ELSE 'Remark ' || CAST(count(*) AS STRING) END AS remarks
       FROM (SELECT ord, assembly, namespace, CASE WHEN length(type_name) = 6 THEN type_name || 'Old' ELSE type_name END AS type_name FROM ({_TYPED}) t) t GROUP BY namespace || '.' || type_name""",
    "enums": f"""SELECT ord, assembly, namespace, namespace || '.' || type_name || '_e' AS fqn, type_name || '_e' AS type_name, member AS enum_member,
         CASE WHEN size % 3 = 0 THEN '' ELSE 'Value ' || member END AS description
       FROM ({_TYPED}) t""",
    "categories": f"""SELECT ord, 'Category ' || substr(type_name, 2, 1) || CAST(size % 5 AS STRING) AS category,
         CASE WHEN length(type_name) = 5 THEN namespace || '.' || type_name || 'Old' WHEN size % 2 = 0 THEN namespace || '.' || type_name ELSE lower(namespace || '.' || type_name) END AS type_fqn
       FROM ({_TYPED}) t""",
    "example_refs": f"""SELECT ord, namespace || '.' || type_name AS fqn, 'Use ' || member AS name,
         CASE WHEN size % 4 = 0 THEN 'C#' WHEN size % 4 = 1 THEN 'VBA' WHEN size % 4 = 2 THEN 'VB.NET' ELSE 'Unknown' END AS language,
         CASE WHEN size % 3 = 0 THEN '/' ELSE '' END || 'api/ex_' || CAST(ord % 150 AS STRING) || '_0.htm' AS url
       FROM ({_TYPED}) t""",
    "examples": """SELECT CAST(conv_id AS BIGINT) * 100 + turn AS ord, 'api/ex_' || CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) || '.htm' AS url,
         'Example ' || CAST(conv_id AS STRING) || chr(10) || 'About ' || role || chr(10) || chr(10) || CASE WHEN turn % 3 = 2 THEN text
           ELSE 'First part' || chr(10) || '<code>' || CASE WHEN conv_id % 4 = 0 THEN 'using System; ' WHEN conv_id % 4 = 1 THEN 'Dim x As Long ' WHEN conv_id % 4 = 2 THEN '#include <x> ' ELSE '' END
             || replace(text, chr(10), ' ') || '</code>' || chr(10) || 'After' END AS content
       FROM {conversations}""",
    "crawl_log": """SELECT event_id AS ord, 'https://docs.example.com/help/api/' || event_type || '/p' || CAST(user_id AS STRING) || CASE WHEN user_id % 7 = 0 THEN '.htm' ELSE '.html' END AS url,
         'html/' || event_type || '/p' || CAST(user_id AS STRING) || '.html' AS file_path, CASE WHEN event_type = 'error' THEN 404 + CAST(user_id % 3 AS INT) * 48 ELSE 200 END AS status,
         CASE WHEN event_type = 'error' THEN 'HTTP ' || CAST(404 + user_id % 3 * 48 AS STRING) END AS error,
         md5(event_type || CAST(user_id % 40 AS STRING)) AS content_hash, CAST(100 + user_id * 3 AS BIGINT) AS content_length,
         CASE WHEN event_id % 50 = 0 THEN '' ELSE 'Page ' || CAST(user_id AS STRING) END AS title
       FROM {events}""",
    "toc": """SELECT 0 AS ord, '1' AS id, '-1' AS parent_id, 'Root' AS name, '' AS url, false AS is_leaf
       UNION ALL SELECT 1 + r_regionkey, '1.' || CAST(r_regionkey AS STRING), '1', r_name, '', false FROM {region}
       UNION ALL SELECT 100 + n_nationkey, '1.' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING), '1.' || CAST(n_regionkey AS STRING), replace(n_name, '_', ': '), '', false FROM {nation}
       UNION ALL SELECT 1000 + s_suppkey, '1.' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING) || '.' || CAST(s_suppkey AS STRING),
         '1.' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING), s_name, '/help/api/guide/s' || CAST(s_suppkey AS STRING) || '.htm', true
         FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
}


def duck(name: str) -> str:
    """The relation as a DuckDB subquery over the registered views."""
    return "(" + BASE[name].format(**{t: t for t in TABLES}) + ")"


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The relation as a DataFrame over the Parquet tables of a directory."""
    used = set(re.findall(r"\{(\w+)\}", BASE[name].replace("{{", "").replace("}}", "")))
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in used}
    return spark.sql(BASE[name].format(**tables))
