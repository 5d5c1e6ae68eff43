"""ludeme.functions"""
