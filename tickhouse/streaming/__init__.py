"""tickhouse.streaming"""
