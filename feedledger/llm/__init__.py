"""llm: operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each operator module has a general interface
(``df -> df``); ``queries`` holds the thin registered queries. Shared conventions: a word is
``[^\\x20\\x09-\\x0D]+``, only A-Z is lower-cased, a null text reads as the empty text.
"""
