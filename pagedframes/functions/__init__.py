from pagedframes.functions.bodies import body_shape, utf8_text, whole_record, whole_variant
from pagedframes.functions.urls import page_query, query_pairs, query_part, query_string, query_values

__all__ = ["body_shape", "utf8_text", "page_query", "query_pairs", "query_part", "query_string", "query_values", "whole_record", "whole_variant"]
