"""Training-data operators: ten distributed transforms over document tables.

Nothing outside this subpackage imports it, except the entry module, which
adds these queries when the subpackage is present.
"""
