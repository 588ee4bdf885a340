"""tickhouse.operators"""
