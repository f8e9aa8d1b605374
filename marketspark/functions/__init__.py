"""Expressions used by the operators.

They take and return SQL text: one parsed text is one call into the JVM, where the
same expression built from Column objects would be a dozen.
"""
