"""Scans: every reader returns a lazy DataFrame over all files of a family."""
