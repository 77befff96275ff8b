"""Lexical and bilingual document processing as DataFrame transformations."""
