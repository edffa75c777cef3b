"""Training-data operators: formatting, quality, tokens, mixing, language, decontamination,
page text, similarity join, repeated passages, licences, snapshots, likelihood and spelling.

Nothing outside this folder imports it; ``sigloom.llm.catalog`` registers its queries.
"""
