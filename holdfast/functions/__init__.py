"""Stateless column expressions. Everything here stays inside Catalyst."""
