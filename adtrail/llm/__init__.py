"""Training-data operators (language ID, quality, dedup, mixing, tokenisation).

Nothing outside this folder imports it.  Each operator is a
``DataFrame -> DataFrame`` function; :mod:`adtrail.llm.queries` registers one
``opN_<name>`` query per operator.
"""
