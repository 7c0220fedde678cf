"""What each query must return, in SQL over the given tables."""

from __future__ import annotations

_INVOICE_JOIN = """
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

_FLAT_INVOICE = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey % 2000000000 AS INTEGER) AS number,
       strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS total, o_orderstatus AS status,
       CAST(c_custkey AS VARCHAR) AS contact_id, c_name AS contact_name, c_acctbal AS contact_balance,
       n_name AS contact_region_name, r_name AS contact_region_group_name,
       c_mktsegment AS audit_by, o_orderstatus = 'F' AS audit_paid,
       'net:' || CAST(floor(o_totalprice * 100) AS BIGINT) || '|held:' || CAST(floor(c_acctbal * 100) AS BIGINT) AS tax_text,
       o_orderpriority || '|' || c_mktsegment AS tag_text,
       strftime(o_orderdate, '%Y-%m-%d') || ':' || c_nationkey AS step_text, coalesce(held, '') AS line_text
{_INVOICE_JOIN}
LEFT JOIN (
  SELECT l_orderkey, string_agg(concat_ws(':', l_partkey, l_linenumber, CAST(floor(l_quantity * 100) AS BIGINT),
           CAST(floor(l_extendedprice * 100) AS BIGINT), CAST(floor(l_discount * 100) AS BIGINT)), '|'
           ORDER BY CAST(l_partkey AS VARCHAR), l_linenumber, l_quantity, l_extendedprice, l_discount) AS held
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""

_EVENT = """
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(user_id AS VARCHAR) AS "user",
       event_type AS kind, value, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k
FROM events
"""

_CONTACT = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
"""

# customers stand for descriptions; @SEG@ and @NATION@ are filled in from the customer
_SPEC = "customer"
_SEG = "upper(c_mktsegment[1]) || lower(c_mktsegment[2:])"


def _filled(column: str) -> str:
    return f"replace(replace({column}, '@SEG@', {_SEG}), '@NATION@', CAST(c_nationkey AS VARCHAR))"


_OPERATIONS = f"""
operations AS (
  SELECT c_custkey AS spec_id, {_filled('e')} AS endpoint, method, {_filled('s')} AS schema_name, schema_type, ord
  FROM {_SPEC}, (VALUES
    (1, '/invoices', 'get', '@SEG@Invoice', 'array'),
    (2, '/invoices', 'post', '@SEG@Invoice', 'object'),
    (3, '/invoices/{{key}}', 'get', '@SEG@Invoice', 'object'),
    (4, '/invoices/{{key}}', 'put', '@SEG@Invoice', 'object'),
    (5, '/invoices/{{key}}', 'delete', '', ''),
    (6, '/contacts', 'get', 'Contact', 'array'),
    (7, '/regions/@NATION@', 'get', 'Region', 'array'),
    (8, '/regions', 'get', 'Region', 'array')
  ) AS t(ord, e, method, s, schema_type))
"""

# (schema, path, type, nullable on its own, nullable along the path, below an array, problem)
_PATHS = f"""
paths AS (
  SELECT c_custkey AS spec_id, {_filled('s')} AS schema_name, path, type, nullable, path_nullable, in_array, problem
  FROM {_SPEC}, (VALUES
    ('Problem', 'message', 'string', true, true, false, NULL),
    ('Group', 'name', 'string', true, true, false, NULL),
    ('Region', 'name', 'string', true, true, false, NULL),
    ('Region', 'group', 'struct', true, true, false, NULL),
    ('Region', 'group.name', 'string', true, true, false, NULL),
    ('Contact', 'id', 'string', false, false, false, NULL),
    ('Contact', 'name', 'string', true, true, false, NULL),
    ('Contact', 'balance', 'double', true, true, false, NULL),
    ('Contact', 'region', 'struct', true, true, false, NULL),
    ('Contact', 'region.name', 'string', true, true, false, NULL),
    ('Contact', 'region.group', 'struct', true, true, false, NULL),
    ('Contact', 'region.group.name', 'string', true, true, false, NULL),
    ('Contact', 'parent', 'struct', true, true, false, 'refers back to Contact'),
    ('Tax', 'label', 'string', true, true, false, NULL),
    ('Tax', 'amount', 'double', true, true, false, NULL),
    ('Line', 'part', 'string', true, true, false, NULL),
    ('Line', 'line', 'int', true, true, false, NULL),
    ('Line', 'quantity', 'double', true, true, false, NULL),
    ('Line', 'price', 'double', true, true, false, NULL),
    ('Line', 'discount', 'double', true, true, false, NULL),
    ('@SEG@Invoice', 'id', 'string', false, false, false, NULL),
    ('@SEG@Invoice', 'number', 'int', true, true, false, NULL),
    ('@SEG@Invoice', 'date', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'total', 'double', true, true, false, NULL),
    ('@SEG@Invoice', 'status', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'contact', 'struct', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.id', 'string', false, true, false, NULL),
    ('@SEG@Invoice', 'contact.name', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.balance', 'double', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.region', 'struct', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.region.name', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.region.group', 'struct', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.region.group.name', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'contact.parent', 'struct', true, true, false, 'refers back to Contact'),
    ('@SEG@Invoice', 'tax_breakdown', 'array<struct>', true, true, false, NULL),
    ('@SEG@Invoice', 'tax_breakdown.label', 'string', true, true, true, NULL),
    ('@SEG@Invoice', 'tax_breakdown.amount', 'double', true, true, true, NULL),
    ('@SEG@Invoice', 'tags', 'array<string>', true, true, false, NULL),
    ('@SEG@Invoice', 'audit', 'struct', true, true, false, NULL),
    ('@SEG@Invoice', 'audit.by', 'string', true, true, false, NULL),
    ('@SEG@Invoice', 'audit.paid', 'boolean', true, true, false, NULL),
    ('@SEG@Invoice', 'audit.steps', 'array<struct>', true, true, false, NULL),
    ('@SEG@Invoice', 'audit.steps.at', 'string', true, true, true, NULL),
    ('@SEG@Invoice', 'audit.steps.n', 'int', true, true, true, NULL),
    ('@SEG@Invoice', 'invoice_lines', 'array<struct>', true, true, false, NULL),
    ('@SEG@Invoice', 'invoice_lines.part', 'string', true, true, true, NULL),
    ('@SEG@Invoice', 'invoice_lines.line', 'int', true, true, true, NULL),
    ('@SEG@Invoice', 'invoice_lines.quantity', 'double', true, true, true, NULL),
    ('@SEG@Invoice', 'invoice_lines.price', 'double', true, true, true, NULL),
    ('@SEG@Invoice', 'invoice_lines.discount', 'double', true, true, true, NULL)
  ) AS t(s, path, type, nullable, path_nullable, in_array, problem))
"""

_FIELD_PROBLEMS = f"""
held AS (
  SELECT l_orderkey, bool_or(l_linenumber = 3) AS third, bool_or(l_discount > 0.09) AS rebate FROM lineitem GROUP BY l_orderkey),
found AS (
  SELECT o_orderkey AS key, UNNEST(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
    THEN [{{'field': '$', 'problem': 'unreadable'}}] ELSE [
    CASE WHEN o_orderpriority = '1-URGENT' THEN {{'field': 'id', 'problem': 'missing'}} END,
    CASE WHEN c_acctbal < 0 THEN {{'field': 'number', 'problem': 'unreadable'}} END,
    CASE WHEN o_orderstatus = 'P' THEN {{'field': 'total', 'problem': 'unreadable'}} END,
    CASE WHEN o_orderstatus = 'P' THEN {{'field': 'tax_breakdown[].amount', 'problem': 'unreadable'}} END,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {{'field': 'extra', 'problem': 'undeclared'}} END,
    CASE WHEN third THEN {{'field': 'invoice_lines[].quantity', 'problem': 'unreadable'}} END,
    CASE WHEN rebate THEN {{'field': 'invoice_lines[].rebate', 'problem': 'undeclared'}} END
  ] END) AS p
  {_INVOICE_JOIN} LEFT JOIN held ON l_orderkey = o_orderkey)
"""

# invoice pages as they were received: how often each came
_RECEIVED = """
sent AS (
  SELECT 'invoice' AS dataset, o_orderkey // 200 + 1 AS page, count(*) AS items,
         arg_min(o_orderstatus, o_orderkey) AS status, arg_min(o_orderpriority, o_orderkey) AS priority
  FROM orders GROUP BY ALL),
received AS (
  SELECT dataset, page, CASE WHEN status = 'O' AND priority = '2-HIGH' THEN 0 ELSE items END AS items,
         CASE WHEN status = 'P' AND priority = '1-URGENT' THEN 0
              WHEN status = 'F' AND priority = '5-LOW' THEN 2 ELSE 1 END AS copies
  FROM sent)
"""

_QUERY = """
query AS (SELECT page_id, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') AS parts
          FROM pages WHERE contains(url, '?')),
part AS (SELECT page_id, UNNEST(parts) AS part, UNNEST(range(len(parts))) AS pos FROM query),
pair AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos,
         url_decode(replace(split_part(part, '=', 1), '+', ' ')) AS key,
         CASE WHEN contains(rtrim(part, '='), '=')
              THEN url_decode(replace(substr(part, instr(part, '=') + 1), '+', ' ')) END AS value
  FROM part)
"""

ORACLE: dict[str, str] = {
    "read_paged": _FLAT_INVOICE,
    "flatten": _FLAT_INVOICE,
    "read_invoices": _FLAT_INVOICE,
    "read_single": "SELECT n_name AS name, r_name AS group_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "read_fleet": _EVENT,
    "read_keyed": """
        SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS key, c_name AS name, c_acctbal AS balance
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT n_name, NULL, NULL FROM nation""",
    "read_empty": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE false",
    "read_dataset": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance FROM customer",
    "unnest_envelope": """
        SELECT 'contact' AS dataset, c_custkey // 200 + 1 AS page,
               (SELECT count(*) FROM customer) AS total, CAST(c_custkey % 200 AS INTEGER) AS pos,
               c_custkey AS id, c_name AS name, c_mktsegment AS segment
        FROM customer""",
    "read_object": _CONTACT,
    "read_array": """
        SELECT c_custkey // 200 + 1 AS page, CAST(c_custkey % 200 AS INTEGER) AS pos,
               CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
        FROM customer""",
    "read_by_key": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS total,
               c_name AS contact_name
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "unmatched_keys": """
        SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem
        WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)""",
    "page_plan": """
        WITH totals AS (SELECT event_type AS dataset, count(*) AS total FROM events GROUP BY event_type)
        SELECT dataset, page, 'kind=' || dataset || '+%26+all&items_per_page=200&page=' || page AS query
        FROM (SELECT dataset, UNNEST(range(1, greatest(1, (total + 199) // 200) + 1)) AS page FROM totals)""",
    "decode_bodies": """
        SELECT 'text' AS kind, doc_id AS body_id, md5(text) AS digest, CAST(length(text) AS INTEGER) AS chars
        FROM documents
        UNION ALL SELECT 'html', page_id, md5(html), CAST(length(html) AS INTEGER) FROM pages
        UNION ALL SELECT 'json', event_id, md5(props), CAST(length(props) AS INTEGER) FROM events""",
    "csv_bodies": """
        SELECT p_partkey // 200 AS body_id, CAST(p_partkey % 200 + 1 AS INTEGER) AS pos,
               CAST(p_partkey AS VARCHAR) AS id,
               CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || '"' || p_brand || '"' ELSE p_name END AS name,
               p_brand AS brand, p_size AS size,
               p_retailprice AS price
        FROM part""",
    "typed_rows": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey % 2000000000 AS INTEGER) AS number, o_totalprice AS total,
               o_orderstatus AS status, CAST(c_custkey AS VARCHAR) AS contact_id, r_name AS group_name,
               o_orderstatus = 'F' AS paid,
               (SELECT CAST(count(*) AS INTEGER) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines
        {_INVOICE_JOIN}""",
    "infer_rows": """
        SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(user_id AS VARCHAR) AS "user", event_type AS kind, value,
               CAST(json_extract(props, '$.k') AS BIGINT) AS props_k
        FROM events""",
    "flatten_schema": f"""
        WITH {_PATHS}
        SELECT spec_id, schema_name, replace(path, '.', '_') AS "column", type, path_nullable AS nullable
        FROM paths WHERE problem IS NULL AND NOT in_array AND type <> 'struct'""",
    "validate": f"""
        WITH {_FIELD_PROBLEMS}
        SELECT p.field AS field, p.problem AS problem, count(*) AS records
        FROM found WHERE p IS NOT NULL GROUP BY ALL""",
    "field_problems": f"""
        WITH {_FIELD_PROBLEMS}
        SELECT key, p.field AS field, p.problem AS problem FROM found WHERE p IS NOT NULL""",
    "page_audit": f"""
        WITH {_RECEIVED}
        SELECT dataset, (SELECT count(*) FROM orders) AS total, CAST(sum(items) AS BIGINT) AS items,
               count(*) AS pages,
               (SELECT (count(*) + 199) // 200 FROM orders) - count(*) AS missing_pages,
               CAST(0 AS BIGINT) AS extra_pages, CAST(sum(copies - 1) AS BIGINT) AS extra_copies,
               sum(items) = (SELECT count(*) FROM orders) AND count(*) = (SELECT (count(*) + 199) // 200 FROM orders) AS complete
        FROM received WHERE copies > 0 GROUP BY dataset""",
    "missing_pages": f"WITH {_RECEIVED} SELECT dataset, CAST(page AS BIGINT) AS page FROM received WHERE copies = 0",
    "repeated_pages": f"WITH {_RECEIVED} SELECT dataset, page, CAST(copies AS BIGINT) AS copies FROM received WHERE copies > 1",
    "body_rejects": """
        SELECT o_orderkey AS page,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'not json' WHEN '2-HIGH' THEN 'not json' WHEN '3-MEDIUM' THEN 'no $items'
                    WHEN '4-NOT SPECIFIED' THEN 'not an object' ELSE 'null body' END AS reason
        FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'P'""",
    "read_filtered": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS date,
               o_totalprice AS total
        FROM orders WHERE o_orderstatus = 'O'""",
    "missing_params": """
        SELECT o_orderkey AS request_id, 'from_date' AS name FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "param_problems": """
        SELECT o_orderkey AS request_id, 'colour' AS name, 'a b&c' AS value, 'unknown' AS problem
        FROM orders WHERE o_orderpriority = '3-MEDIUM'
        UNION ALL
        SELECT o_orderkey, NULL, NULL, 'unknown endpoint /estimates' FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "enum_violations": """
        SELECT o_orderkey AS request_id, 'status' AS name, o_orderstatus AS value
        FROM orders WHERE o_orderstatus NOT IN ('O', 'F') AND o_orderpriority <> '2-HIGH'""",
    "request_query": """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_orderpriority = '2-HIGH' THEN '/estimates' ELSE '/invoices' END AS endpoint,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'colour=a+b%26c&' ELSE '' END
               || CASE WHEN o_orderpriority <> '1-URGENT'
                       THEN 'from_date=' || strftime(o_orderdate, '%Y-%m-%d') || '&' ELSE '' END
               || 'status=' || o_orderstatus AS query
        FROM orders""",
    "url_params": f"WITH {_QUERY} SELECT page_id, pos, key, value FROM pair",
    "url_param_values": f"""
        WITH {_QUERY}
        SELECT page_id, key, CAST(count(*) AS INTEGER) AS n,
               coalesce(string_agg(value, '|' ORDER BY pos), '') AS "values"
        FROM pair GROUP BY page_id, key""",
    "spec_endpoints": f"WITH {_OPERATIONS} SELECT spec_id, endpoint, method, schema_name, schema_type FROM operations",
    "spec_read_paths": f"""
        WITH {_OPERATIONS}
        SELECT spec_id, endpoint, method, schema_name, schema_type FROM operations WHERE method = 'get'""",
    "spec_write_paths": f"""
        WITH {_OPERATIONS}
        SELECT spec_id, endpoint, method, schema_name, schema_type FROM operations WHERE method <> 'get'""",
    "spec_params": f"""
        SELECT c_custkey AS spec_id, {_filled('e')} AS endpoint, 'get' AS method, pos, name, type, enum, required
        FROM {_SPEC}, (VALUES
          ('/invoices', 0, 'page', 'integer', '', false),
          ('/invoices', 1, 'items_per_page', 'integer', '', false),
          ('/invoices', 2, 'status', 'string', 'O|F', false),
          ('/invoices', 3, 'from_date', 'string', '', true),
          ('/invoices/{{key}}', 0, 'show_legacy', 'boolean', '', false),
          ('/contacts', 0, 'page', 'integer', '', false),
          ('/contacts', 1, 'items_per_page', 'integer', '', false),
          ('/regions', 0, 'show_legacy', 'boolean', '', false)
        ) AS t(e, pos, name, type, enum, required)""",
    "spec_datasets": f"WITH {_OPERATIONS} SELECT spec_id, schema_name, schema_type FROM operations WHERE method = 'get'",
    "dataset_endpoint": f"""
        WITH {_OPERATIONS}
        SELECT spec_id, schema_name, CASE WHEN contains(endpoint, '{{key}}') THEN 'item' ELSE 'list' END AS kind,
               arg_max(endpoint, ord) AS endpoint, arg_max(schema_type, ord) AS schema_type
        FROM operations WHERE method = 'get' GROUP BY ALL""",
    "spec_fields": f"""
        SELECT c_custkey AS spec_id, {_filled('s')} AS schema_name, pos, field, type, nullable, ref, problem
        FROM {_SPEC}, (VALUES
          ('Problem', 0, 'message', 'string', true, NULL, NULL),
          ('Group', 0, 'name', 'string', true, NULL, NULL),
          ('Region', 0, 'name', 'string', true, NULL, NULL),
          ('Region', 1, 'group', 'struct', true, 'Group', NULL),
          ('Contact', 0, 'id', 'string', false, NULL, NULL),
          ('Contact', 1, 'name', 'string', true, NULL, NULL),
          ('Contact', 2, 'balance', 'double', true, NULL, NULL),
          ('Contact', 3, 'region', 'struct', true, 'Region', NULL),
          ('Contact', 4, 'parent', 'struct', true, 'Contact', 'refers back to Contact'),
          ('Tax', 0, 'label', 'string', true, NULL, NULL),
          ('Tax', 1, 'amount', 'double', true, NULL, NULL),
          ('Line', 0, 'part', 'string', true, NULL, NULL),
          ('Line', 1, 'line', 'int', true, NULL, NULL),
          ('Line', 2, 'quantity', 'double', true, NULL, NULL),
          ('Line', 3, 'price', 'double', true, NULL, NULL),
          ('Line', 4, 'discount', 'double', true, NULL, NULL),
          ('@SEG@Invoice', 0, 'id', 'string', false, NULL, NULL),
          ('@SEG@Invoice', 1, 'number', 'int', true, NULL, NULL),
          ('@SEG@Invoice', 2, 'date', 'string', true, NULL, NULL),
          ('@SEG@Invoice', 3, 'total', 'double', true, NULL, NULL),
          ('@SEG@Invoice', 4, 'status', 'string', true, NULL, NULL),
          ('@SEG@Invoice', 5, 'contact', 'struct', true, 'Contact', NULL),
          ('@SEG@Invoice', 6, 'tax_breakdown', 'array<struct>', true, 'Tax', NULL),
          ('@SEG@Invoice', 7, 'tags', 'array<string>', true, NULL, NULL),
          ('@SEG@Invoice', 8, 'audit', 'struct', true, NULL, NULL),
          ('@SEG@Invoice', 9, 'invoice_lines', 'array<struct>', true, 'Line', NULL)
        ) AS t(s, pos, field, type, nullable, ref, problem)""",
    "spec_field_paths": f"WITH {_PATHS} SELECT spec_id, schema_name, path, type, nullable, problem FROM paths",
    "spec_base_url": """
        SELECT c_custkey AS spec_id, 'https://api-' || c_custkey || '.example.test/v' || c_nationkey AS base_url
        FROM customer""",
    "stream_pages": """
        SELECT 'event' AS dataset, page, n AS total
        FROM (SELECT count(*) AS n, UNNEST(range(1, (count(*) + 199) // 200 + 1)) AS page FROM events)""",
    "stream_items": _EVENT,
    "stream_api": _EVENT,
}
