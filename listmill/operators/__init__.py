"""DataFrame -> DataFrame operators.

Those on URL sets store and measure what they look up; no other runs an action or writes.
"""
