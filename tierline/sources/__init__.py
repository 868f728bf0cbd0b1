"""Typed readers for the inputs and the stored layers."""
