"""Composable, lazy DataFrame operators for tabular, geographic, recommendation and stream work."""
