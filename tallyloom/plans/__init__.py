"""The questionnaire itself: its columns and one builder per output table.

Several tables exist in two variants. *direct* keeps keys and answers as delivered; *cleaned* repairs keys,
reads checkboxes tolerantly and checks reported counts.
"""
